"""Cross-entropy difference of two n-gram language models.

A target and a background model are matched: both are bigram models over one
shared vocabulary (every word of all documents), with the same interpolation

    P(w | v) = (c(v, w) + ``PRIOR`` * P(w)) / (c(v) + ``PRIOR``),
    P(w) = (c(w) + 1) / (N + size of the vocabulary),

one counted over the trusted target documents, the other over all documents. A
document's score is the mean over its tokens of target loss minus background
loss in nats: below 0 it is closer to the target.

Counts cover all documents; the vocabulary and the bigram table grow with them.
Words are 64-bit hashes, so no list of words is held anywhere; bigrams, contexts
and words are counted under one 61-bit hash each, with their kind. Tasks count
``BLOCK`` tokens at a time and send the sorted keys and counts of each range of
keys (bucket) as packed arrays, which a bucket's task merges. What stands once in
all documents is not kept: a key found nowhere has the count 1, in the target if
its document is trusted.

At most ``HEAD`` of the most frequent keys go to every task, with ``MARK_BITS``
bits that mark the others of two or more. Tokens whose keys are in the head or
not marked are scored at once. For the others, a block of documents asks the
buckets for its distinct marked keys and scores them when the counts are back;
only keys, counts and the state of those tokens move, never texts. Questions and
states are computed from the documents apart, rather than stored; blocks are
named by their place and content, and a state whose replies are missing (a source
that gives other blocks when read again) fails. A document's first word follows a
fixed start context.

Defined results: a null or empty text has no tokens and score 0. Without target
documents every score is 0. Repeated rows are counted and scored each. A null
id is scored and never trusted. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from practica.llm.common import SLICE_ROWS, map_batches, release_memory, small_side, texts_of
from practica.llm.hashing import mix, word_hasher
from practica.llm.packed import (bucket_bits, bucket_rows, cut_by_bucket, joined_marks, mark_range, marked, merged, pack,
                                 unpack, unpacked)
from practica.llm.tokens import worker_cache
from practica.session import materialize

HEAD = 1_500_000            # keys, about 20 bytes each in a task
MARK_BITS = 26              # 8 MB in a task
BLOCK = 1_000_000           # tokens
BUCKET_BYTES = 4 << 20      # of text for each bucket of keys
STEPS = 4                   # classes of counts for each power of two
PRIOR = 4.0
UNKNOWN, START = 0, 1       # in the place of a word's hash
FIRST = 2
TURN = 23                   # bits
PAIR, WORD, CONTEXT = range(3)


def with_trust(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, trusted 0/1) of every row."""
    ids = materialize(trusted.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct(), "lm_trusted")
    side = small_side(ids.withColumn("_t", F.lit(1)), ids.count())
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .join(side, F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", "text", F.coalesce("_t", F.lit(0)).alias("trusted")))


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One hash for each bigram; hashes of words are mixed already."""
    w = w.view(np.uint64)
    return v ^ ((w << np.uint64(TURN)) | (w >> np.uint64(64 - TURN))).view(np.int64)


def keys_of(v: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    """Keys of each token's bigram, word and context; the lowest bit is free."""
    found = (pair_key(v, w).view(np.uint64), mix(w.view(np.uint64)), mix(v.view(np.uint64)))
    return [(h & ~np.uint64(7)) | np.uint64(kind << 1) for kind, h in enumerate(found)]


def kind_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(1)) & np.uint64(3)


class Vocabulary:
    """Words as they are counted: their hashes, or ``UNKNOWN`` for those that
    are not in ``hashes`` if a list is given."""

    def __init__(self, hashes: list[int] | None = None):
        self.hashes = None if hashes is None else np.sort(np.array(hashes, np.int64))

    @property
    def size(self) -> int | None:
        return None if self.hashes is None else len(self.hashes) + FIRST

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.view(np.int64)
        if self.hashes is None:
            return h
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, h, UNKNOWN)

    def bigrams(self, hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, word, row) of every token."""
        row = np.repeat(np.arange(len(counts)), counts)
        word = self.ids(hashes)
        context = np.concatenate([[START], word[:-1]]) if len(word) else word.copy()
        starts = np.concatenate([[0], np.cumsum(counts)])[:-1][counts > 0]
        context[starts] = START
        return context, word, row


def count_keys(rows: DataFrame, words: Vocabulary, bits: int) -> DataFrame:
    """(bucket, keys, n, t), packed: one row for each block of tokens and bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            raw = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            raw.sort()
            first = np.nonzero(np.append(len(raw) > 0, (raw[1:] ^ raw[:-1]) > np.uint64(1)))[0]
            n = np.diff(np.append(first, len(raw)))
            t = np.add.reduceat(raw & np.uint64(1), first) if len(first) else np.zeros(0, np.uint64)
            return bucket_rows(raw[first] & ~np.uint64(1), bits, n=n, t=t)
        tokens = 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                trusted = part.column("trusted").to_numpy().astype(np.uint64)
                for first, hashes, counts in word_hasher().groups(texts_of(part)):
                    v, w, row = words.bigrams(hashes, counts)
                    held += [k | trusted[first + row] for k in keys_of(v, w)]
                    tokens += len(row)
                    if tokens >= BLOCK:
                        yield out()
                        release_memory()
                        tokens = 0
            del batch
            release_memory()
        yield out()
        release_memory()
    return rows.select("text", "trusted").mapInArrow(run, "bucket long, keys binary, n binary, t binary")


def classes(n: np.ndarray) -> np.ndarray:
    """Class of each count: ``STEPS`` for each power of two."""
    power = np.floor(np.log2(np.maximum(n, 1).astype(np.float64))).astype(np.int64)
    return power * STEPS + (n.astype(np.float64) / 2.0 ** power * STEPS).astype(np.int64) - STEPS


def key_table(counts: DataFrame) -> DataFrame:
    """(bucket, keys, n, t, words, total_n, total_t, histogram): what stands twice
    or more; distinct words and tokens of the bucket, keys in each class."""
    def merge(rows: pa.Table) -> pa.Table:
        keys, n, t = merged(*(unpacked(rows.column(c)) for c in ("keys", "n", "t")))
        word = kind_of(keys) == WORD
        more = n > 1
        return pa.table({
            "bucket": rows.column("bucket").slice(0, 1), "keys": pa.array([pack(keys[more])]),
            "n": pa.array([pack(n[more])]), "t": pa.array([pack(t[more])]),
            "words": pa.array([int(word.sum())]), "total_n": pa.array([int(n[word].sum())]),
            "total_t": pa.array([int(t[word].sum())]),
            "histogram": pa.array([np.bincount(classes(n[more])).tolist()], pa.list_(pa.int64()))})
    return counts.groupBy("bucket").applyInArrow(
        merge, "bucket long, keys binary, n binary, t binary, words long, total_n long, total_t long, histogram array<long>")


def shared_vocabulary(rows: DataFrame, limit: int | None = None) -> Vocabulary:
    """All words, or with a limit that many of the most frequent ones."""
    if limit is None:
        return Vocabulary()
    def run(batch: pa.RecordBatch) -> dict:
        found = [h.view(np.int64) for _, h, _ in word_hasher().groups(texts_of(batch))]
        w, n = np.unique(np.concatenate(found), return_counts=True)
        return {"w": pa.array(w), "n": pa.array(n)}

    words = map_batches(rows.select("text"), run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return Vocabulary([r["w"] for r in words.orderBy(F.desc("n"), "w").limit(limit).collect()])


def least_class(table: DataFrame, limit: int) -> int:
    """The least class such that at most ``limit`` keys are in it and above."""
    found = (table.select(F.posexplode("histogram").alias("class", "keys")).groupBy("class")
             .agg(F.sum("keys").alias("keys")).collect())
    rows, least = 0, 1 << 20
    for r in sorted(found, key=lambda r: -r["class"]):
        rows += r["keys"]
        if rows > limit:
            break
        least = r["class"]
    return least


class Head:
    """The most frequent keys, and marks of the others that stand more than once."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, t: np.ndarray, marks: np.ndarray, sums: tuple[int, int, int]):
        self.keys, self.n, self.t, self.marks, self.sums = keys, n, t, marks, sums
        # Keys are spread evenly: a cell for each first few bits finds them in a step or two.
        self.shift = np.uint64(64 - max(1, len(keys).bit_length() - 1))
        cells = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64)
        self.start = np.append(np.searchsorted(keys, cells << self.shift), len(keys)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, -1 where it isn't in the head."""
        cell = (keys >> self.shift).astype(np.int32)
        at, stop = self.start[cell], self.start[cell + 1]
        out = np.full(len(keys), -1)
        left = np.nonzero(at < stop)[0]
        while len(left):
            here = at[left]
            hit = self.keys[here] == keys[left]
            out[left[hit]] = here[hit]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out

    def counts(self, at: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, t) of the keys at these places, for -1 those of a key that stands
        once, in a document that is trusted or not (``own``)."""
        n, t = np.ones(len(at), np.uint64), own.astype(np.uint64)
        known = at >= 0
        n[known], t[known] = self.n[at[known]], self.t[at[known]]
        return n, t

    def losses(self, n: list[np.ndarray], t: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(target, background) of tokens from the counts of their three keys."""
        size, total_n, total_t = self.sums
        out = []
        for (pair, word, context), total in ((t, total_t), (n, total_n)):
            p = (word + 1.0) / (total + size)
            out.append(-np.log((pair + PRIOR * p) / (context + PRIOR)))
        return out[0], out[1]


def broadcast_head(table: DataFrame, head_size: int, vocabulary: int | None):
    """Broadcast (name, parts of ``Head``) from the stored table."""
    least = least_class(table, head_size)

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"keys": [], "n": [], "t": [], "byte": [], "marks": []}
        for columns in zip(*(batch.column(c).to_pylist() for c in ("keys", "n", "t"))):
            keys, n, t = map(unpack, columns)
            often = classes(n) >= least
            for name, x in (("keys", keys), ("n", n), ("t", t)):
                out[name].append(pack(x[often]))
            begin, marks = mark_range(keys[~often], MARK_BITS)
            out["byte"].append(begin)
            out["marks"].append(marks)
        return {k: pa.array(v, pa.int64() if k == "byte" else pa.binary()) for k, v in out.items()}

    rows = map_batches(table.select("keys", "n", "t"), run, "keys binary, n binary, t binary, byte long, marks binary").toArrow()
    keys, n, t = merged(*(unpacked(rows.column(c)) for c in ("keys", "n", "t")))
    marks = joined_marks(list(zip(rows.column("byte").to_pylist(), rows.column("marks").to_pylist())), MARK_BITS)
    narrow = np.uint32 if not len(n) or n.max() < 1 << 32 else np.uint64
    total = table.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "total_n", "total_t")]).first()
    sums = (total[0] + FIRST if vocabulary is None else vocabulary, total[1], total[2])
    whole = not marks.any()
    value = (uuid.uuid4().hex, (keys, n.astype(narrow), t.astype(narrow), marks, sums))
    return table.sparkSession.sparkContext.broadcast(value), whole, total[2]


def head_of(sent) -> Head:
    """The process's form of a broadcast."""
    cache = worker_cache().__dict__
    name, parts = sent.value
    if cache.get("lm_head_for") != name:
        cache["lm_head"], cache["lm_head_for"] = Head(*parts), name
    return cache["lm_head"]


BLOCKS = ("block string, doc_id array<long>, n_tokens array<long>, trusted array<long>, loss_t array<double>, "
          "loss_b array<double>, state array<binary>, buckets array<long>, keys array<binary>")


def score_blocks(rows: DataFrame, words: Vocabulary, sent, bits: int) -> DataFrame:
    """One row for each block of documents: sums of the tokens that can be scored
    (``loss_t``, ``loss_b``), the keys to ask for, and in ``state`` the others' row
    and, for each of their three keys, 0 for one that stands once, else 1 + its
    place in the head, behind that in the keys asked for."""
    def block(part: pa.RecordBatch, place: str) -> dict:
        head, content = head_of(sent), hashlib.blake2b(place.encode(), digest_size=16)
        size = part.num_rows
        trusted = part.column("trusted").to_numpy().astype(np.int64)
        tokens, sums = np.zeros(size, np.int64), np.zeros((2, size))
        rest: list[list[np.ndarray]] = []
        for first, hashes, counts in word_hasher().groups(texts_of(part)):
            content.update(hashes.tobytes() + counts.tobytes())
            v, w, row = words.bigrams(hashes, counts)
            row = row + first
            tokens[first:first + len(counts)] = counts
            keys = keys_of(v, w)
            places = [head.find(k) for k in keys]
            ask = [(at < 0) & marked(k, head.marks) for k, at in zip(keys, places)]
            late = ask[0] | ask[1] | ask[2]
            done = ~late
            counts_of = [head.counts(at[done], trusted[row[done]]) for at in places]
            for side, loss in enumerate(head.losses(*zip(*counts_of))):
                sums[side] += np.bincount(row[done], loss, size)
            if late.any():
                rest.append([row[late], *(x[late] for x in (*places, *ask, *keys))])
        state, buckets, packed = [], np.zeros(0, np.int64), []
        if rest:
            row, *columns = (np.concatenate(c) for c in zip(*rest))
            places, ask, keys = (columns[i:i + 3] for i in (0, 3, 6))
            asked = np.unique(np.concatenate([k[a] for k, a in zip(keys, ask)]))
            for k, a, at in zip(keys, ask, places):
                at[a] = len(head.keys) + np.searchsorted(asked, k[a])
            state = [pack(x) for x in (row, *(at + 1 for at in places))]
            buckets, edge = cut_by_bucket(asked, bits)
            packed = [pack(asked[a:b]) for a, b in zip(edge[:-1], edge[1:])]
        return {"block": content.hexdigest(), "doc_id": part.column("doc_id").to_pylist(), "n_tokens": tokens.tolist(),
                "trusted": trusted.tolist(), "loss_t": sums[0].tolist(), "loss_b": sums[1].tolist(), "state": state,
                "buckets": buckets.tolist(), "keys": packed}

    kinds = pa.schema([("block", pa.string()), ("doc_id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
                       ("trusted", pa.list_(pa.int64())), ("loss_t", pa.list_(pa.float64())), ("loss_b", pa.list_(pa.float64())),
                       ("state", pa.list_(pa.binary())), ("buckets", pa.list_(pa.int64())), ("keys", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for i, batch in enumerate(batches):
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield pa.RecordBatch.from_pylist([block(batch.slice(at, SLICE_ROWS), f"{task}:{i}:{at}")], kinds)
            del batch
            release_memory()
    return rows.mapInArrow(run, BLOCKS)


def answers(blocks: DataFrame, table: DataFrame) -> DataFrame:
    """(block, bucket, n, t) for all keys that blocks ask for; 0 for those not kept."""
    asked = (blocks.select("block", F.explode(F.arrays_zip("buckets", "keys")).alias("x"))
             .select("block", F.col("x.buckets").alias("bucket"), F.col("x.keys").alias("keys")))

    def answer(kept: pa.Table, asks: pa.Table) -> pa.Table:
        keys, n, t = (unpacked(kept.column(c)) for c in ("keys", "n", "t"))
        out = []
        for wanted in map(unpack, asks.column("keys").to_pylist()):
            at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
            hit = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            counts = []
            for x in (n, t):
                counts.append(np.zeros(len(wanted), np.uint64))
                counts[-1][hit] = x[at[hit]]
            out.append(list(map(pack, counts)))
        return pa.table({"block": asks.column("block"), "bucket": asks.column("bucket"),
                         "n": pa.array([o[0] for o in out], pa.binary()), "t": pa.array([o[1] for o in out], pa.binary())})

    return (table.select("bucket", "keys", "n", "t").groupBy("bucket").cogroup(asked.groupBy("bucket"))
            .applyInArrow(answer, "block string, bucket long, n binary, t binary"))


SCORES = "doc_id long, n_tokens long, loss_t double, loss_b double"


def finished(blocks: DataFrame, replies: DataFrame, sent) -> DataFrame:
    """Document sums of all blocks, with their replies."""
    def finish(block: pa.Table, replied: pa.Table) -> pa.Table:
        held = block.to_pylist()[0]
        replied = replied.sort_by("bucket")
        if replied.column("bucket").to_pylist() != held["buckets"]:
            raise RuntimeError("replies are missing: the documents were read in other blocks")
        sums = [np.array(held[c]) for c in ("loss_t", "loss_b")]
        if held["buckets"]:
            head, row, *places = head_of(sent), *(unpack(x).astype(np.int64) for x in held["state"])
            found, share = (unpacked(replied.column(c)) for c in ("n", "t"))
            own, many = np.array(held["trusted"], np.int64)[row], len(head.keys)
            counts = []
            for at in places:
                n, t = head.counts(np.where(at > many, 0, at) - 1, own)
                late = at > many
                asked = at[late] - many - 1
                n[late] = np.maximum(found[asked], np.uint64(1))
                t[late] = np.where(found[asked] == 0, own[late].astype(np.uint64), share[asked])
                counts.append((n, t))
            sums = [s + np.bincount(row, loss, len(s)) for s, loss in zip(sums, head.losses(*zip(*counts)))]
        return pa.table({"doc_id": pa.array(held["doc_id"], pa.int64()), "n_tokens": pa.array(held["n_tokens"], pa.int64()),
                         "loss_t": pa.array(sums[0]), "loss_b": pa.array(sums[1])})
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finish, SCORES)


def score_documents(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    vocabulary_size: int | None = None, head_size: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background (means a token), score."""
    rows = with_trust(docs, trusted, id_col, text_col)
    words = shared_vocabulary(rows, vocabulary_size)
    bits = bucket_bits(rows, "text", BUCKET_BYTES)
    table = materialize(key_table(count_keys(rows, words, bits)), "lm_keys")
    sent, whole, target = broadcast_head(table, head_size, words.size)
    blocks = score_blocks(rows, words, sent, bits)
    if whole:
        parts = F.explode(F.arrays_zip("doc_id", "n_tokens", "loss_t", "loss_b")).alias("x")
        sums = blocks.select(parts).select("x.*")
    else:
        sums = finished(blocks.drop("keys"), answers(blocks, table), sent)
    n = F.greatest(F.col("n_tokens"), F.lit(1))
    out = sums.select("doc_id", "n_tokens", (F.col("loss_t") / n).alias("loss_target"),
                      (F.col("loss_b") / n).alias("loss_background"))
    score = F.col("loss_target") - F.col("loss_background") if target else F.lit(0.0)
    return out.withColumn("score", score)
