"""Sharding by minimax contiguous partition.

Equal texts form one atomic group. The groups stand in one fixed order (hash
bucket, then digest); contiguous runs of them become the shards. The smallest
feasible capacity is found by binary search, each candidate checked greedily,
and the order is cut within that capacity.

The search runs on the driver over *bounds* of the groups' end positions: one
Spark aggregate gives the smallest and largest end in each of a few thousand
blocks of the byte axis. Where a greedy step cannot be decided from the bounds,
only the blocks it touches are looked at again, finer. The answer is exact and
the driver never holds more than ``EXACT_POINTS`` positions, whatever the input.

Defined results: a null text has size 1 (no bytes, plus 1) and CRC 0, like the
empty text, and is in its group. Repeated rows are
rows of their text's group and each gets a slot. A null doc_id is kept. An empty
table gives an empty result. If one group exceeds the mean shard, the capacity
is that group's size and some shards may stay empty.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from practica.llm.common import buckets_for, gapless_slots, offsets
from practica.session import materialize

BLOCKS = 4096
EXACT_POINTS = 200_000


@dataclass
class Segment:
    """Group ends in one stretch of the axis: the least and largest end are
    known; ``inner`` counts the ends whose position is not."""
    first: int
    last: int
    inner: int


class EndPositions:
    """Sorted group ends, known exactly or within bounds; refined on demand."""

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.total = ends, total
        self.touched: set[int] = set()
        width = max(1, -(-total // BLOCKS))
        self.segments = self._summary(self.ends, width)
        self._index()

    @staticmethod
    def _summary(ends: DataFrame, width: int) -> list[Segment]:
        rows = (ends.groupBy((F.col("end") / F.lit(width)).cast("long").alias("block"))
                .agg(F.min("end").alias("first"), F.max("end").alias("last"), F.count("*").alias("n"))
                .collect())
        return sorted((Segment(r["first"], r["last"], max(0, r["n"] - 2)) for r in rows),
                      key=lambda s: s.first)

    def _index(self) -> None:
        self.firsts = [s.first for s in self.segments]
        self.lasts = [s.last for s in self.segments]
        self.touched = set()

    def floor(self, at: int) -> tuple[int, int]:
        """Bounds of the largest end <= ``at`` (0 if there is none)."""
        i = bisect.bisect_right(self.firsts, at) - 1
        if i < 0:
            return 0, 0
        s = self.segments[i]
        if at >= s.last:
            return s.last, s.last
        if not s.inner:
            return s.first, s.first
        self.touched.add(i)
        return s.first, at

    def ceil(self, at: int) -> tuple[int, int]:
        """Bounds of the smallest end >= ``at`` (at <= total)."""
        if at <= 0:
            return 0, 0
        i = bisect.bisect_left(self.lasts, at)
        s = self.segments[i]
        if at <= s.first:
            return s.first, s.first
        if not s.inner:
            return s.last, s.last
        self.touched.add(i)
        return at, s.last

    def refine(self, which: set[int]) -> None:
        """Look again, finer, at these segments: all their ends if they are few,
        else the bounds of smaller blocks."""
        which = {i for i in which if self.segments[i].inner}
        if not which:
            return
        spans: list[list[int]] = []
        for i in sorted(which):
            s = self.segments[i]
            if spans and i - 1 in which:
                spans[-1][1] = s.last
            else:
                spans.append([s.first, s.last])
        inside = F.lit(False)
        for a, b in spans:
            inside = inside | F.col("end").between(a, b)
        part = self.ends.filter(inside)
        if sum(self.segments[i].inner + 2 for i in which) <= EXACT_POINTS:
            fresh = [Segment(r[0], r[0], 0) for r in part.select("end").collect()]
        else:
            reach = sum(b - a for a, b in spans)
            fresh = self._summary(part, max(1, -(-reach // BLOCKS)))
        kept = [s for i, s in enumerate(self.segments) if i not in which]
        self.segments = sorted(kept + fresh, key=lambda s: s.first)
        self._index()

    def between(self, a: int, b: int) -> set[int]:
        """Open segments that meet [a, b]."""
        lo = bisect.bisect_left(self.lasts, a)
        hi = bisect.bisect_right(self.firsts, b)
        return {i for i in range(lo, hi) if self.segments[i].inner}


def _greedy(ends: EndPositions, capacity: int, shards: int, side: int) -> list[int]:
    """Fill shards one after another; side 0 takes the lower bound of each
    step, 1 the upper."""
    cuts, at = [], 0
    for _ in range(shards):
        at = ends.total if at + capacity >= ends.total else ends.floor(at + capacity)[side]
        cuts.append(at)
    return cuts


def _smallest(low: int, high: int, holds) -> int:
    """Smallest value in (low, high] for which the monotone test holds; it
    holds at ``high``."""
    while high - low > 1:
        mid = (low + high) // 2
        if holds(mid):
            high = mid
        else:
            low = mid
    return high


def minimax_capacity(ends: EndPositions, shards: int, largest: int) -> int:
    """The smallest capacity for which greedy filling needs at most ``shards``."""
    floor = max(-(-ends.total // shards), largest) - 1
    while True:
        sure = _smallest(floor, max(floor + 1, ends.total),
                         lambda c: _greedy(ends, c, shards, 0)[-1] == ends.total)
        maybe = _smallest(floor, max(floor + 1, ends.total),
                          lambda c: _greedy(ends, c, shards, 1)[-1] == ends.total)
        if sure == maybe:
            return sure
        wanted: set[int] = set()
        for a, b in zip(_greedy(ends, maybe, shards, 0), _greedy(ends, sure, shards, 1)):
            wanted |= ends.between(a, b)
        ends.refine(wanted)


def minimax_cuts(ends: EndPositions, shards: int, largest: int) -> tuple[int, list[int]]:
    """Capacity and the ``shards - 1`` cut positions. No shard exceeds the
    smallest feasible capacity; within it each cut is the group end nearest to
    its even share."""
    capacity = minimax_capacity(ends, shards, largest)
    while True:
        ends.touched = set()
        latest = _greedy(ends, capacity, shards, 0)
        earliest, at = [0] * shards, ends.total
        for j in range(shards - 1, 0, -1):
            at = ends.ceil(max(0, at - capacity))[1]
            earliest[j] = at
        cuts, at = [], 0
        for j in range(1, shards):
            even = ends.total * j // shards
            below, above = ends.floor(even)[0], ends.ceil(even)[1]
            near = below if even - below <= above - even else above
            reach = ends.total if at + capacity >= ends.total else ends.floor(at + capacity)[0]
            at = min(max(near, earliest[j], at), reach, latest[j - 1])
            cuts.append(at)
        if not ends.touched:
            return capacity, cuts
        ends.refine(ends.touched)


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Every row with its size, CRC, shard and slot; see the module docstring."""
    rows = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text_col), F.lit(0)).cast("long").alias("text_crc32"),
        F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("digest")), "sharding_rows")
    buckets = buckets_for(rows.count())
    groups = (rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
              .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets))))
    base = offsets(groups, ["bucket"], [], F.sum("bytes"), "before")
    within = Window.partitionBy("bucket").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    ends = materialize(groups.withColumn("_sum", F.sum("bytes").over(within)).join(base, "bucket")
                       .select("digest", "bytes", (F.col("_sum") + F.col("before")).alias("end")),
                       "sharding_groups")
    total, largest = ends.agg(F.max("end"), F.max("bytes")).first()
    cuts: list[int] = []
    if total:
        _, cuts = minimax_cuts(EndPositions(ends.select("end"), total), shards, largest)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("end") > cut).cast("int")
    placed = materialize(rows.join(ends.select("digest", shard.alias("shard")), "digest")
                         .select("doc_id", "size", "text_crc32", "shard"), "sharding_placed")
    return (gapless_slots(placed, "shard", ["doc_id", "text_crc32", "size"], buckets)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"), "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
