"""Mixing sources to target weights by Sainte-Laguë apportionment.

A source's documents stand in one seeded order; its words, laid end to end,
are cut into blocks of ``BLOCK_WORDS`` (the last may be shorter). The number of
blocks that the mix takes is apportioned to sources by highest quotients
v / (2k + 1) of their target words, then, within a source, to its shards
(stretches of its order) in the same way, so each shard has an integer quota.
A shard takes every block ``quota // blocks`` times and a seeded, evenly
spread choice of its blocks once more. A document's words in taken blocks are
its words in the mix.

Words are summed by source and shard (partial sums before the shuffle); only
one row for each source and shard, at most about ``MAX_SHARDS`` plus the number
of sources, reaches the driver. A hot source has more shards, not larger ones.

Defined results: a null text has size 0 and takes nothing. Sources stand in
code point order, null last, and weigh 3, 1, 2, repeating. A source without
words has target 0. Repeated rows are rows of their own; ones that agree in
every column may take different shares, in a fixed multiset. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from practica.llm.common import WORD, map_batches, replaced, texts_of, word_count
from practica.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)      # of all words
MOST = 2                    # times a source's own words
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 15
MAX_SHARDS = 1 << 13
SEED = 17


def targets(sizes: list[int], weights: list[int], share: Fraction = SHARE, most: int = MOST) -> list[Fraction]:
    """Words for each source: ``share`` of all, by weight, none above ``most``
    times its own; what a full source leaves is shared again by weight."""
    out = [Fraction(0)] * len(sizes)
    left, open_ = share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients v / (2k + 1), at most ``most`` each; ties to
    the smaller index. The bulk is given at once by the divisor that the last
    seat would have, the rest seat by seat."""
    votes, most = np.asarray(votes, float), np.asarray(most, np.int64)
    seats = int(min(seats, most[votes > 0].sum()))
    held = np.zeros(len(votes), np.int64)
    if seats <= 0:
        return held

    def given(divisor: float) -> np.ndarray:
        return np.minimum(np.floor(votes / divisor + 0.5).astype(np.int64), most)

    low, high = votes[votes > 0].min() / (4.0 * (seats + 1)), 4 * votes.max()
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if given(mid).sum() > seats else (low, mid)
    held = given(high)
    while held.sum() < seats:
        quotient = np.where((held < most) & (votes > 0), votes / (2 * held + 1), -1.0)
        held[int(np.argmax(quotient))] += 1
    return held


class Plan:
    """Quotas of the shards of one source, and how many words of the source's
    first x positions the mix takes."""

    def __init__(self, source_words: int, shard_words: list[int], quota: int, block: int, offsets: list[float]):
        starts = np.concatenate([[0], np.cumsum(shard_words)]).astype(np.int64)
        self.block, self.words = block, source_words
        self.first = -(-starts[:-1] // block)              # first block that begins in the shard
        end = np.append(self.first[1:], -(-source_words // block))
        self.blocks = end - self.first
        self.quota = sainte_lague(self.blocks, quota, MOST * self.blocks)
        self.offset = np.asarray(offsets)
        some = np.maximum(self.blocks, 1)
        self.every, self.extra = self.quota // some, self.quota % some
        self.before = np.concatenate([[0], np.cumsum(self.quota)])

    def _taken_blocks(self, shard: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Blocks (repeats counted) taken of the first k blocks of a shard."""
        n = np.maximum(self.blocks[shard], 1)
        u = np.floor(self.offset[shard] * n).astype(np.int64)
        spread = ((k + u) * self.extra[shard]) // n - (u * self.extra[shard]) // n
        return k * self.every[shard] + spread

    def taken(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.int64)
        whole = x // self.block
        shard = np.clip(np.searchsorted(self.first, whole, side="right") - 1, 0, None)
        k = whole - self.first[shard]
        done = self._taken_blocks(shard, k)
        times = self._taken_blocks(shard, k + 1) - done
        return (self.before[shard] + done) * self.block + (x - whole * self.block) * times

    def times(self, block: np.ndarray) -> np.ndarray:
        """How often each of these blocks is taken."""
        shard = np.clip(np.searchsorted(self.first, block, side="right") - 1, 0, None)
        k = block - self.first[shard]
        return self._taken_blocks(shard, k + 1) - self._taken_blocks(shard, k)


def plan_mix(rows: list[tuple], block: int = BLOCK_WORDS, weights=WEIGHTS, seed: int = SEED) -> dict:
    """``rows``: (source, shard, words), sources in order and shards by number.
    Returns {source: (target, words, {shard: first position}, Plan)}."""
    by: dict = {}
    for source, shard, words in rows:
        by.setdefault(source, []).append((shard, words))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(w for _, w in by[s]) for s in names]
    weight = [weights[i % len(weights)] for i in range(len(names))]
    want = targets(sizes, weight)
    blocks = np.array([-(-s // block) for s in sizes], np.int64)
    quotas = sainte_lague(np.array([float(t) for t in want]), round(sum(want) / block), MOST * blocks)
    out = {}
    for i, name in enumerate(names):
        shards = sorted(by[name])
        words = [w for _, w in shards]
        draw = np.random.default_rng([seed, i]).random(len(shards))
        begins = np.concatenate([[0], np.cumsum(words)[:-1]]).astype(int) if words else []
        quota = MOST * int(blocks[i]) if want[i] == MOST * sizes[i] else int(quotas[i])
        out[name] = (float(want[i]), sizes[i], {s: int(b) for (s, _), b in zip(shards, begins)},
                     Plan(sizes[i], words, quota, block, list(draw)))
    return out


def place_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: int = SEED) -> tuple[DataFrame, dict]:
    """(rows with source, shard and ``_from``, their first word's place in the
    shard; the plan). Stored, so that both passes see one order."""
    rows = materialize(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                   word_count(F.col(text_col)).alias("size"),
                                   F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("_key")), "mix_rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = totals.agg(F.sum("source_size")).first()[0] or 0
    shard_words = max(SHARD_WORDS, -(-every // MAX_SHARDS))
    count = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(shard_words)))
    order = F.xxhash64("doc_id", "_key", F.lit(seed))
    dealt = (rows.join(totals, rows["source"].eqNullSafe(totals["source"])).drop(totals["source"])
             .withColumn("_order", order)
             .withColumn("shard", F.pmod(F.xxhash64("_order", F.lit("shard")), count).cast("long")))
    w = Window.partitionBy("source", "shard").orderBy("_order", "doc_id", "size")
    w = w.rowsBetween(Window.unboundedPreceding, -1)
    placed = materialize(dealt.withColumn("_from", F.coalesce(F.sum("size").over(w), F.lit(0)))
                         .select("doc_id", "source", "shard", "size", "_key", "_from"), "mix_placed")
    sums = placed.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect()
    return placed, plan_mix([tuple(r) for r in sums])


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source") -> DataFrame:
    """One row per document: size, source_size, target, taken."""
    placed, plan = place_words(docs, id_col, text_col, source_col)

    def run(batch: pa.RecordBatch) -> dict:
        sources, shards = batch.column("source").to_pylist(), batch.column("shard").to_pylist()
        start, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_from", "size"))
        taken, total, target = (np.zeros(len(sources), t) for t in (np.int64, np.int64, float))
        where: dict = {}
        for i, s in enumerate(sources):
            where.setdefault(s, []).append(i)
        for s, at in where.items():
            target[at], total[at], begins, p = plan[s]
            a = start[at] + np.array([begins[shards[i]] for i in at], np.int64)
            taken[at] = p.taken(a + size[at]) - p.taken(a)
        return {"doc_id": batch.column("doc_id"), "size": batch.column("size"),
                "source_size": pa.array(total), "target": pa.array(target), "taken": pa.array(taken)}

    return map_batches(placed, run, "doc_id long, size long, source_size long, target double, taken long")


def _copies(text: str, start: int, size: int, plan: Plan) -> list[str]:
    """The texts that the mix takes of a document whose words are ``start`` to
    ``start + size`` of its source: one for each time that some block is taken,
    whole or with the words of the blocks taken that often."""
    first = start // plan.block
    times = plan.times(np.arange(first, (start + size - 1) // plan.block + 1))
    out, spans = [], None
    for c in range(1, int(times.max()) + 1):
        taken = times >= c
        if taken.all():
            out.append(text)
            continue
        if spans is None:
            spans = [m.span() for m in re.finditer(WORD, text)]
        edges = np.diff(np.concatenate([[0], taken.astype(np.int8), [0]]))
        runs = zip(np.nonzero(edges == 1)[0] + first, np.nonzero(edges == -1)[0] + first)
        words = [(max(0, a * plan.block - start), min(size, b * plan.block - start)) for a, b in runs]
        out.append("\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in words))
    return out


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each time that a
    document, or some of its blocks, is taken; ``n_chars`` follows the text."""
    placed, plan = place_words(docs, id_col, text_col, source_col)
    mine = {"_id": F.col(id_col), "_source": F.col(source_col).cast("string"),
            "_key": F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))}
    rows = docs.withColumns(mine)
    where = placed.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), "_key",
                          F.col("shard").alias("_shard"), F.col("size").alias("_size"), "_from")
    keys = ["_id", "_source", "_key"]
    if not where.groupBy(*keys).count().filter("count > 1").isEmpty():
        # Repeated rows: number them on both sides.
        rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
        where = where.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy("_shard", "_from")))
        keys = [*keys, "_nth"]
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = (rows.alias("a").join(where.filter("_size > 0").alias("b"), same)
              .select(*[F.col(f"a.{c}") for c in docs.columns], "a._source", "b._shard", "b._size", "b._from"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, texts = [], []
        mine = [batch.column(c).to_pylist() for c in ("_source", "_shard", "_size", "_from")]
        for i, (text, source, shard, size, start) in enumerate(zip(texts_of(batch, text_col), *mine)):
            _, _, begins, p = plan[source]
            found = _copies(text, begins[shard] + start, size, p)
            at += [i] * len(found)
            texts += found
        batch = batch.drop_columns(["_source", "_shard", "_size", "_from"]).take(pa.array(at, pa.int64()))
        return replaced(batch, {text_col: texts, "n_chars": [len(t) for t in texts]})
    return map_batches(joined, run, docs.schema)
