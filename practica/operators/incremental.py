"""Keyed incremental load: cutoffs, upsert merge, schema sync, safe writes.

A stored table is a directory of immutable versions ``<root>/v=<n>``. Facts and
histories are made of parts (``practica.operators.parts``): a run writes the
partitions that it touches and carries the others. Other tables are written in
full. Readers take the highest complete version, so a job that dies mid-write
leaves the previous version current, and no plan ever overwrites the path it
reads.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.operators.parts import MANIFEST, Stored, drop_folder, merge_into, open_table, version_numbers
from practica.operators.scd2 import assert_unique
from practica.semantics import WATERMARK_FLOOR
from practica.session import CODEC, free_shuffles


# ------------------------------------------------------------------ cutoffs
def _greatest(table: DataFrame | Stored, column: str):
    """From the manifest of a stored table (no job), else one aggregate."""
    if isinstance(table, Stored):
        return table.bounds(column)[1]
    return table.agg(F.max(column).alias("m")).first()["m"]


def month_before(day: dt.date | None) -> dt.date | None:
    """add_months(day, -1)."""
    if day is None:
        return None
    last = day.replace(day=1) - dt.timedelta(days=1)
    return last.replace(day=min(day.day, last.day))


def month_cutoff(df: DataFrame | Stored, date_col: str = "date") -> dt.date | None:
    """add_months(max(date), -1): the one-month lookback of the monthly facts.

    An empty relation gives None; what the caller then loads is
    ``Semantics.empty_target``.
    """
    return month_before(_greatest(df, date_col))


def last_update_watermark(target: DataFrame | Stored) -> dt.datetime:
    """coalesce(max(last_update), 1900-01-01) of the stored project fact."""
    v = _greatest(target, "last_update")
    return v if v is not None else WATERMARK_FLOOR


# -------------------------------------------------------------------- merge
def sync_columns(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Align the stored rows to the new schema: columns gone from the new
    rows are dropped, new columns are NULL for old rows (sync_all_columns)."""
    have = set(target.columns)
    return target.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in updates.schema.fields])


def merge_upsert(target: DataFrame | None, updates: DataFrame, key: str,
                 validate: bool = True) -> DataFrame:
    """Rows of ``updates`` replace stored rows with the same key; other stored
    rows stay. Duplicate keys in ``updates`` are refused.

    Plan: the stored table anti-joins the update keys (adaptive execution
    broadcasts the key set when the batch is small), then the batch is
    appended. ``parts.merge_into`` does this within the touched partitions.
    """
    if validate:
        assert_unique(updates, key, "merge updates")
    if target is None:
        return updates
    kept = sync_columns(target, updates).join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates)


# ------------------------------------------------------- versioned storage
def list_versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions: those with a manifest, for a table without any those
    whose job succeeded."""
    return version_numbers(spark, root, MANIFEST) or version_numbers(spark, root, "_SUCCESS")


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    stored = open_table(spark, root)
    if stored is not None:
        return stored.frame()
    vs = list_versions(spark, root)
    return spark.read.parquet(f"{root}/v={vs[-1]}") if vs else None


def keep_last(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete versions of a table written in full but the last ``keep`` complete
    ones (and any after them). Returns the paths deleted."""
    gone = [n for n in version_numbers(spark, root) if n < min(list_versions(spark, root)[-keep:], default=0)]
    for n in gone:
        drop_folder(spark, f"{root}/v={n}")
    return [f"{root}/v={n}" for n in gone]


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as the next version of ``root``; returns its path."""
    spark = df.sparkSession
    out = f"{root}/v={max(version_numbers(spark, root), default=0) + 1}"
    if partition_by:    # a partition's rows together: few files for each
        df = df.repartition(*partition_by)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(out)
    return out


def incremental_refresh(spark: SparkSession, root: str, build, key: str, partition_by: list[str],
                        statistics: tuple[str, ...] = ()) -> Stored:
    """Build the batch against the current version (``build(stored or None)``),
    and merge it into the partitions that it touches."""
    target = open_table(spark, root)
    # the batch is checked, joined and appended: written once, read several times
    batch = f"{root}/_batches/{uuid.uuid4().hex}"
    build(target).write.parquet(batch, compression=CODEC)
    free_shuffles(spark)
    updates = spark.read.parquet(batch)
    assert_unique(updates, key, "merge updates")
    new = merge_into(target, updates, root, key, partition_by, statistics)
    drop_folder(spark, batch)
    return new
