"""Phrase collocations by prefix-free parsing.

Texts are cut into pieces and words. A word whose bytes hash to 0 modulo
``PERIOD`` is a trigger: each piece is parsed into chunks that begin at its
first word and at every trigger, so equal passages give equal chunks wherever
they stand. A chunk carries the next ``MOST_WORDS`` - 1 words of its piece as an
overlap (after a tab). The dictionary of distinct chunks with their parse
frequencies then stands for the corpus: the phrases that begin in a chunk's own
part are counted in it once, times its frequency, so that every occurrence is
counted exactly once and a passage that stands a million times is read once.

Counting goes by length. A phrase can only reach ``LEAST`` if its words do, and of
three words both pairs; a pair only if its hash does. Words are counted first,
then hashes of the pairs of words that reach it (packed, by bucket), then pairs
and triples themselves. What passed before is marked in a fixed number of bits
which every task gets, and other phrases are left out before the shuffle. Marks
only save work: a phrase that passes by chance is counted exactly and dropped by
its count. Scores are whole-number arithmetic on decimals of 38 digits. The best
of each language are ranked within parts of it first.

Result: for each language its first ``TOP`` phrases, with the counts of the
phrase, of both sides of its lowest-scoring cut and of all words.

Defined results: a null text is the empty text, a null lang is ``und``. Repeated
rows count each. Phrases of equal score and count are ranked by their bytes. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from practica.llm.common import SLICE_ROWS, release_memory, texts_of
from practica.llm.hashing import mix, word_hasher
from practica.llm.packed import bucket_bits, bucket_rows, joined_marks, mark_range, marked, merged, unpacked
from practica.session import materialize

MOST_WORDS = 3
LEAST = 10
TOP = 2_000
PERIOD = 12
MARK_BITS = 26              # 8 MB in every task, whatever the input
HELD = 250_000              # distinct chunks or words that a task holds at a time
BLOCK = 500_000             # pairs or triples
BUCKET_BYTES = 8 << 20      # of chunks for each bucket of pair hashes
BROADCAST_BYTES = 8 << 20
SALTS = 64
# Bytes of a text: A-Z in lower case, ends of pieces as line feeds, tabs as spaces.
ENDS = b".,;:!?\n\x0b\x0c\r"
_BYTES = bytes(10 if c in ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_EDGES, _SPACES = re.compile(b" *\n[ \n]*"), re.compile(b"  +")
_OVERLAPS = re.compile("\t[^\n]*")


def plain(texts: list[str]) -> bytes:
    """Pieces divided by one line feed, words by one space, no other white space
    of either kind."""
    data = "\n".join(texts).encode("utf-8", "replace").translate(_BYTES)
    if b"  " in data:
        data = _SPACES.sub(b" ", data)
    return _EDGES.sub(b"\n", data).strip(b" \n")


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, divider behind) of every word."""
    b = np.frombuffer(data + b"\n", np.uint8)
    end = np.nonzero((b == 32) | (b == 10) | (b == 9))[0]
    start = np.append(0, end[:-1] + 1)
    return b, start, end, b[end]


def triggers(b: np.ndarray, start: np.ndarray, end: np.ndarray, period: int) -> np.ndarray:
    """Words that begin a chunk, by their length and last four bytes."""
    h = (end - start).astype(np.uint32)
    for back in range(1, 5):
        at = end - back
        h = h * np.uint32(0x01000193) ^ np.where(at >= start, b[np.maximum(at, 0)], 0).astype(np.uint32)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return h % np.uint32(period) == 0


def parse(texts: list[str], period: int = PERIOD) -> Iterator[bytes]:
    """Chunks of the texts: own words, and after a tab those of the overlap."""
    data = plain(texts)
    if not data:
        return
    b, start, end, behind = _words(data)
    last = behind == 10                                     # last words of pieces
    first = np.append(True, last[:-1])
    cut = np.nonzero(first | triggers(b, start, end, period))[0]
    upto = np.append(cut[1:], len(start))                   # behind the own words
    stop = np.nonzero(last)[0] + 1
    piece_end = stop[np.searchsorted(stop, cut, side="right")]
    over = np.minimum(upto + MOST_WORDS - 1, piece_end)
    own = zip(start[cut].tolist(), end[upto - 1].tolist(), end[over - 1].tolist())
    for a, z, o in own:
        yield data[a:z] if o <= z else data[a:z] + b"\t" + data[z + 1:o]


def chunk_dictionary(docs: DataFrame, period: int = PERIOD) -> DataFrame:
    """(lang, chunk, n) of the columns ``lang`` and ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([k for k, c in seen.items() for _ in c], pa.string()),
                "chunk": pa.array([x for c in seen.values() for x in c], pa.binary()).cast(pa.string()),
                "n": pa.array([n for c in seen.values() for n in c.values()], pa.int64())})
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = defaultdict(list)
                for lang, text in zip(part.column("lang").to_pylist(), texts_of(part)):
                    texts[lang].append(text)
                for lang, some in texts.items():
                    seen[lang].update(parse(some, period))
                if sum(map(len, seen.values())) >= HELD:
                    yield out()
                    seen.clear()
            del batch
        yield out()
        release_memory()

    return (docs.select("lang", "text").mapInArrow(run, "lang string, chunk string, n long")
            .groupBy("lang", "chunk").agg(F.sum("n").alias("n")))


def word_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, without a step for each."""
    hasher = word_hasher()
    hasher._grow(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * hasher.up[:len(b)], out=total[1:])
    return mix((total[end] - total[start]) * hasher.down[start] + (end - start).astype(np.uint64))


def joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def salt_of(lang: str) -> int:
    return int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")


class Layout:
    """Words of some chunks and where they stand."""

    def __init__(self, chunks: pa.Array, langs: pa.Array):
        b, self.start, self.end, behind = _words("\n".join(chunks.to_pylist()).encode())
        closes = behind == 10
        self.chunk = np.cumsum(np.append(0, closes[:-1]))
        tabs = np.cumsum(np.append(0, behind[:-1] == 9))
        first = np.nonzero(np.append(True, closes[:-1]))[0]
        self.own = tabs == tabs[first][self.chunk]
        names = langs.dictionary_encode()
        self.langs, self.code = names.dictionary, names.indices.to_numpy()
        salts = np.array([salt_of(x) for x in self.langs.to_pylist()], np.uint64)
        self.hash = mix(word_hashes(b, self.start, self.end) ^ salts[self.code[self.chunk]])
        self.bytes = np.where(b == 9, 32, b).astype(np.uint8)

    def places(self, length: int) -> np.ndarray:
        """First words of all phrases of this many words that begin in own parts."""
        at = np.nonzero(self.own[:len(self.own) - length + 1])[0]
        return at[self.chunk[at + length - 1] == self.chunk[at]]

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        start, end = self.start[at], self.end[at + length - 1]
        size = end - start
        offset = np.append(0, np.cumsum(size))
        data = self.bytes[np.repeat(start - offset[:-1], size) + np.arange(offset[-1])]
        return pa.Array.from_buffers(pa.large_string(), len(at),
                                     [None, pa.py_buffer(offset.astype(np.int64)), pa.py_buffer(data)])


    def pair(self, at: np.ndarray) -> np.ndarray:
        return joined_hash(self.hash[at], self.hash[at + 1])

    def table(self, at: np.ndarray, length: int, n: np.ndarray) -> pa.Table:
        """(lang, phrase, n) of these places, ``n`` for each chunk."""
        code = pa.array(self.code[self.chunk[at]].astype(np.int32))
        return pa.table({"lang": pa.DictionaryArray.from_arrays(code, self.langs).cast(pa.string()),
                         "phrase": self.phrases(at, length), "n": pa.array(n[self.chunk[at]])})


def by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, pa.Array]]:
    """(lang, chunks, n) of the rows of each language."""
    for lang in batch.column("lang").unique().to_pylist():
        rows = batch.filter(pc.equal(batch.column("lang"), lang))
        yield lang, rows.column("chunk"), rows.column("n")


def own_words(chunks: pa.Array) -> list[str]:
    """Words of the chunks' own parts."""
    text = _OVERLAPS.sub("", "\n".join(chunks.to_pylist()))
    return text.replace("\n", " ").split(" ") if text else []


def count_words(chunks: DataFrame) -> DataFrame:
    """(lang, phrase, n) of all words in the chunks' own parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "lang": pa.array([k for k, c in seen.items() for _ in c], pa.string()),
                "phrase": pa.array([x for c in seen.values() for x in c], pa.string()),
                "n": pa.array([n for c in seen.values() for n in c.values()], pa.int64())})
        for batch in batches:
            for lang, chunks, n in by_lang(batch):
                once = pc.equal(n, 1)
                seen[lang].update(own_words(chunks.filter(once)))
                rest = pc.invert(once)
                for chunk, times in zip(chunks.filter(rest).to_pylist(), n.filter(rest).to_pylist()):
                    for w in chunk.partition("\t")[0].split(" "):
                        seen[lang][w] += times
            if sum(map(len, seen.values())) >= HELD:
                yield out()
                seen.clear()
            del batch
        yield out()
        release_memory()

    return (chunks.mapInArrow(run, "lang string, phrase string, n long")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("n")))


def count_pair_hashes(chunks: DataFrame, words, bits: int) -> DataFrame:
    """(bucket, keys, n), packed, of the pairs of marked words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            keys, n = merged(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return bucket_rows(keys, bits, n=n)
        for batch in batches:
            if not batch.num_rows:
                continue
            layout = Layout(batch.column("chunk"), batch.column("lang"))
            known = marked(layout.hash, words.value)
            at = layout.places(2)
            at = at[known[at] & known[at + 1]]
            held.append((layout.pair(at), batch.column("n").to_numpy().astype(np.uint64)[layout.chunk[at]]))
            del batch, layout
            if sum(len(k) for k, _ in held) >= BLOCK:
                yield out()
        if held:
            yield out()
        release_memory()
    return chunks.mapInArrow(run, "bucket long, keys binary, n binary")


def count_phrases(chunks: DataFrame, pairs) -> DataFrame:
    """(words, lang, phrase, n) of the phrases of two and three words whose pairs
    are marked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, pa.Table]] = []

        def out() -> Iterator[pa.RecordBatch]:
            for length in range(2, MOST_WORDS + 1):
                whole = (pa.concat_tables([t for k, t in held if k == length]).group_by(["lang", "phrase"])
                         .aggregate([("n", "sum")]))
                yield from pa.table({"words": pa.array(np.full(whole.num_rows, length, np.int32)), "lang": whole["lang"],
                                     "phrase": whole["phrase"].cast(pa.string()),
                                     "n": whole["n_sum"]}).to_batches(max_chunksize=50_000)
            held.clear()
        for batch in batches:
            if not batch.num_rows:
                continue
            layout, n = Layout(batch.column("chunk"), batch.column("lang")), batch.column("n").to_numpy()
            at = layout.places(2)
            at = at[marked(layout.pair(at), pairs.value)]
            held.append((2, layout.table(at, 2, n)))
            longer = np.intersect1d(layout.places(3), at, assume_unique=True)
            longer = longer[marked(layout.pair(longer + 1), pairs.value)]
            held.append((3, layout.table(longer, 3, n)))
            del batch, layout
            if sum(t.num_rows for _, t in held) >= BLOCK:
                yield from out()
                release_memory()
        if held:
            yield from out()
        release_memory()

    return (chunks.mapInArrow(run, "words int, lang string, phrase string, n long")
            .groupBy("words", "lang", "phrase").agg(F.sum("n").alias("n")))


def _sent(rows: DataFrame, mark_bits: int):
    """Broadcast marks of (byte, marks) rows."""
    found = rows.toArrow()
    marks = joined_marks(list(zip(found.column("byte").to_pylist(), found.column("marks").to_pylist())), mark_bits)
    return rows.sparkSession.sparkContext.broadcast(marks)


def mark_words(words: DataFrame, mark_bits: int):
    """Broadcast marks of the stored words: at most as many rows as bytes of marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h = Layout(batch.column("phrase"), batch.column("lang")).hash >> np.uint64(64 - mark_bits)
                yield pa.RecordBatch.from_pydict({"byte": pa.array((h >> np.uint64(3)).astype(np.int64)),
                                                  "bit": pa.array((h & np.uint64(7)).astype(np.int32))})
    rows = (words.select("lang", "phrase").mapInArrow(run, "byte long, bit int").groupBy("byte")
            .agg(F.expr("bit_or(shiftleft(1, bit))").alias("marks")))
    return _sent(rows.select("byte", F.unhex(F.lpad(F.hex("marks"), 2, "0")).alias("marks")), mark_bits)


def mark_pairs(hashes: DataFrame, least: int, mark_bits: int):
    """Broadcast marks of the pair hashes that reach ``least``: one row for each bucket."""
    def merge(rows: pa.Table) -> pa.Table:
        keys, n = merged(unpacked(rows.column("keys")), unpacked(rows.column("n")))
        begin, marks = mark_range(keys[n >= least], mark_bits)
        return pa.table({"byte": pa.array([begin], pa.int64()), "marks": pa.array([marks], pa.binary())})
    return _sent(hashes.groupBy("bucket").applyInArrow(merge, "byte long, marks binary"), mark_bits)


def _small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its phrases and counts are few bytes."""
    size = df.agg(F.sum(F.octet_length("phrase") + F.octet_length("lang") + 40)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    wide = [c.cast("decimal(18,0)") for c in (a, left, right)]
    square = (wide[0] * wide[0]).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", square, wide[1] * wide[2])


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST,
                 top: int = TOP, period: int = PERIOD, mark_bits: int = MARK_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    chunks = materialize(chunk_dictionary(rows, period), "phrase_chunks")
    words = materialize(count_words(chunks), "phrase_words")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    often = words.filter(F.col("n") >= least)
    hashes = count_pair_hashes(chunks, mark_words(often, mark_bits), bucket_bits(chunks, "chunk", BUCKET_BYTES))
    likely = mark_pairs(hashes, least, mark_bits)
    found = materialize(count_phrases(chunks, likely).filter(F.col("n") >= least), "phrase_counts")
    pairs, triples = (found.filter(F.col("words") == k).drop("words") for k in (2, 3))

    part = F.split("phrase", " ")
    sides = _small(often), _small(pairs)

    def with_count(df: DataFrame, side: DataFrame, phrase: Column, name: str) -> DataFrame:
        side = side.select("lang", F.col("phrase").alias("_side"), F.col("n").alias(name))
        return df.withColumn("_side", phrase).join(side, ["lang", "_side"]).drop("_side")

    def pair(i: int) -> Column:
        return F.concat_ws(" ", part[i], part[i + 1])

    inside = (triples.select("lang", F.explode(F.array(pair(0), pair(1))).alias("phrase"), "n")
              .groupBy("lang", "phrase").agg(F.max("n").alias("_longer")))
    two = (pairs.join(inside, ["lang", "phrase"], "left")
           .filter(F.coalesce(F.col("_longer") * 100 < F.col("n") * 50, F.lit(True))).select("lang", "phrase", "n"))
    two = with_count(with_count(two, sides[0], part[0], "l"), sides[0], part[1], "r")
    two = two.select("lang", "phrase", F.col("n").alias("a"), "l", "r", score(F.col("n"), F.col("l"), F.col("r")).alias("score"))

    three = with_count(with_count(triples, sides[0], part[0], "l1"), sides[0], part[2], "r2")
    three = with_count(with_count(three, sides[1], pair(0), "l2"), sides[1], pair(1), "r1")
    cuts = [F.struct(score(F.col("n"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                     F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.withColumn("_cut", F.least(*cuts)).select("lang", "phrase", F.col("n").alias("a"), "_cut.l", "_cut.r",
                                                            "_cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = two.unionByName(three).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    best = best.filter(F.col("rank") <= top).drop("_part")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    best = best.filter(F.col("rank") <= top).join(total, "lang")
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                       F.col("total").alias("n"), F.col("score").cast("long").alias("score"))
