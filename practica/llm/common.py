"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Word characters of every word-based operator: all but space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
# Bytes up to which a keyed side may be broadcast; beyond it the same join shuffles.
BROADCAST_BYTES = 64 << 20
# Rows that a Python function holds at a time.
SLICE_ROWS = 512


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def small_side(df: DataFrame, rows: int, row_bytes: int = 100, limit: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its ``rows`` (counted) of at most
    ``row_bytes`` are at most ``limit`` bytes; otherwise unchanged, so the join
    shuffles."""
    return F.broadcast(df) if rows * row_bytes <= (BROADCAST_BYTES if limit is None else limit) else df


def buckets_for(rows: int, per_bucket: int = 50_000, least: int = 64) -> int:
    """Number of hash buckets that hold about ``per_bucket`` rows each."""
    return max(least, -(-rows // per_bucket))


def release_memory() -> None:
    """Give freed memory back to the system: workers live on between tasks, and
    an executor's memory limit counts what they keep."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):   # another C library
        return


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | dict | None],
                schema: str | StructType) -> DataFrame:
    """Apply ``fn`` to slices of the Arrow batches; a dict result becomes a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                out = fn(batch.slice(at, SLICE_ROWS))
                if out is not None:
                    yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out)
            del batch
            release_memory()
    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def offsets(df: DataFrame, keys: list[str], within: list[str], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over the smaller buckets, for each bucket (``keys``) of
    a group (``within``). One row for each bucket is all that the window sees."""
    totals = df.groupBy(*keys).agg(value.alias("_total"))
    bucket = [k for k in keys if k not in within]
    w = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    w = w.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*keys, F.coalesce(F.sum("_total").over(w), F.lit(0)).alias(name))


def gapless_slots(rows: DataFrame, group: str, order: list[str], buckets: int) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... within each ``group``, by hash bucket and then
    ``order``. Numbering inside a bucket needs only that bucket's rows."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    base = offsets(rows, [group, "_bucket"], [group], F.count("*"), "_base")
    inside = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order)) - 1
    return (rows.withColumn("_inside", inside).join(base, [group, "_bucket"])
            .withColumn("slot", (F.col("_base") + F.col("_inside")).cast("long"))
            .drop("_bucket", "_base", "_inside"))


def map_sorted_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table, list[int]], dict | pa.Table],
                      schema: str) -> DataFrame:
    """Bring rows together by ``keys`` and call ``fn(rows, starts)`` on runs of
    whole groups; ``starts`` holds each group's first row and the number of
    rows. Groups of a few rows cost no call of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(table: pa.Table) -> list[int]:
            change = None
            for k in keys:
                c = table.column(k).combine_chunks()
                differs = pc.not_equal(c.slice(1), c.slice(0, len(c) - 1))
                change = differs if change is None else pc.or_(change, differs)
            return [0, *[i + 1 for i in pc.indices_nonzero(change).to_pylist()]]

        def done(table: pa.Table, starts: list[int]) -> Iterator[pa.RecordBatch]:
            out = fn(table, [*starts, table.num_rows])
            yield from out.to_batches() if isinstance(out, pa.Table) else [pa.RecordBatch.from_pydict(out)]

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held)
            starts = edges(table)
            if len(starts) > 1:
                yield from done(table.slice(0, starts[-1]), starts[:-1])
                held = table.slice(starts[-1]).to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from done(table, edges(table))
        table, held = None, []
        release_memory()
    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def without_rows(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys are not in the stored table ``gone``. Texts stay
    where they are while ``gone`` is small enough to broadcast."""
    side = small_side(gone.alias("gone"), gone.count())
    same = [F.col(f"here.{k}").eqNullSafe(F.col(f"gone.{k}")) for k in keys]
    return df.alias("here").join(side, same, "left_anti")


def replaced(batch: pa.RecordBatch, columns: dict[str, list]) -> pa.RecordBatch:
    """``batch`` with these columns, where it has them, holding new values."""
    for name, values in columns.items():
        at = batch.schema.get_field_index(name)
        if at >= 0:
            batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
    return batch
