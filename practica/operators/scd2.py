"""Type-2 history with the check strategy, and validity-interval intersection.

``scd2_snapshot`` takes the stored history and the incoming staged rows and
returns the next history:

* open row whose check columns differ (null-safe) -> closed at ``run_ts`` and
  a new open row from the incoming values;
* key not seen before -> new open row;
* unchanged key, or key missing from the input -> row kept as is (no hard
  deletes);
* closed rows pass through untouched.

One full outer join of the *open* rows with the input on the key (both sides
shuffle by key once), then every joined row emits at most two versions
through one ``inline`` -- no second pass over the join. Closed history is
appended without a shuffle; a stored history (``snapshot_parts``) leaves it where
it is.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.functions.keys import ntz
from practica.operators.parts import Stored, open_table, same_types, write_parts

VALID_FROM, VALID_TO = "valid_from", "valid_to"
OPEN_END = dt.datetime(9999, 12, 31)
PART, OPEN = "part", "open"     # of a stored history


@dataclass(frozen=True)
class SnapshotSpec:
    key: str
    check_cols: tuple[str, ...]
    columns: tuple[str, ...] | None = None  # None: every staged column


# Fixed configuration of the seven histories (key, check columns, kept columns).
SNAPSHOTS: dict[str, SnapshotSpec] = {
    "businessunit": SnapshotSpec("business_unit_id", ("business_unit_name",)),
    "client": SnapshotSpec("client_id", ("client_name", "phone_number", "email")),
    "consultant": SnapshotSpec("consultant_id",
                               ("business_unit_id", "first_name", "last_name", "contact")),
    "title_assignment": SnapshotSpec("record_id",
                                     ("consultant_id", "title_id", "start_date", "end_date")),
    "deliverable": SnapshotSpec("deliverable_id", ("project_id", "name", "price", "due_date")),
    "project": SnapshotSpec(
        "project_id",
        ("client_id", "unit_id", "project_name", "project_type", "price", "planned_start_date",
         "planned_end_date"),
        ("project_id", "client_id", "unit_id", "project_name", "project_type", "price",
         "planned_start_date", "planned_end_date")),
    "title": SnapshotSpec("title_id", ("title_name",)),
}


class DuplicateKeyError(ValueError):
    pass


def _ts(value) -> Column:
    return ntz(value)


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, key: str | list[str], what: str = "input") -> None:
    """Fail on a duplicated key. One aggregate job; only the first offender
    reaches the driver."""
    bad = duplicate_keys(df, key).limit(1).collect()
    if bad:
        raise DuplicateKeyError(f"{what}: duplicate key {bad[0].asDict()}")


def refuse_bad_keys(incoming: DataFrame, key: str) -> DataFrame:
    """``incoming``, failing when run on a NULL or duplicate key. A subquery
    counts the key column alone; the rows are neither grouped nor moved."""
    value = F.col(key)
    said = (F.when(value.isNull(), F.lit(f"snapshot: NULL key {key}"))
            .otherwise(F.concat(F.lit(f"snapshot: duplicate key {key} = "), value.cast("string"))))
    bad = (incoming.groupBy(key).agg(F.count("*").alias("_n")).filter(value.isNull() | (F.col("_n") > 1))
           .agg(F.min(said)).scalar())
    return incoming.filter(F.coalesce(F.when(bad.isNotNull(), F.raise_error(bad)).cast("boolean"), F.lit(True)))


def next_versions(incoming: DataFrame, spec: SnapshotSpec, run_ts: dt.datetime,
                  opened: DataFrame | None = None) -> DataFrame:
    """The open rows after the run and those that it closes, from the rows open
    before it. Fails on a NULL or duplicate incoming key, and where ``run_ts`` is
    not later than an open row's start."""
    cols = list(spec.columns or incoming.columns)
    incoming = refuse_bad_keys(incoming, spec.key)
    ts = _ts(run_ts)
    if opened is None:
        return incoming.select(*cols, ts.alias(VALID_FROM), _ts(None).alias(VALID_TO))
    opened = opened.select(*cols, VALID_FROM, VALID_TO)

    h = opened.select(*[F.col(c).alias(f"h_{c}") for c in opened.columns], F.lit(True).alias("h_"))
    i = incoming.select(*[F.col(c).alias(f"i_{c}") for c in cols], F.lit(True).alias("i_"))
    j = h.join(i, F.col(f"h_{spec.key}") == F.col(f"i_{spec.key}"), "full_outer")

    h_on = F.col("h_").isNotNull()
    i_on = F.col("i_").isNotNull()
    same = reduce(lambda a, b: a & b,
                  [F.col(f"h_{c}").eqNullSafe(F.col(f"i_{c}")) for c in spec.check_cols])
    changed = h_on & i_on & ~same

    old = F.struct(*[F.col(f"h_{c}").alias(c) for c in cols],
                   F.col(f"h_{VALID_FROM}").alias(VALID_FROM),
                   F.when(changed, ts).otherwise(F.col(f"h_{VALID_TO}")).alias(VALID_TO))
    new = F.struct(*[F.col(f"i_{c}").alias(c) for c in cols], ts.alias(VALID_FROM),
                   _ts(None).alias(VALID_TO))
    versions = F.filter(F.array(F.when(h_on, old), F.when(i_on & (~h_on | changed), new)),
                        lambda v: v.isNotNull())
    return j.select(F.inline(versions))


def scd2_snapshot(incoming: DataFrame, spec: SnapshotSpec, run_ts: dt.datetime,
                  history: DataFrame | None = None) -> DataFrame:
    """The next history. Running it fails on a NULL or duplicate incoming key,
    and where ``run_ts`` is not later than every validity in the history."""
    if history is None:
        return next_versions(incoming, spec, run_ts)
    late = F.when(F.greatest(VALID_FROM, VALID_TO) >= _ts(run_ts), F.raise_error(F.lit(
        f"snapshot: run at {run_ts} is not later than the history"))).cast("timestamp_ntz")
    history = history.withColumn(VALID_FROM, F.coalesce(late, F.col(VALID_FROM)))
    cols = list(spec.columns or incoming.columns)
    closed = history.filter(F.col(VALID_TO).isNotNull()).select(*cols, VALID_FROM, VALID_TO)
    return closed.unionByName(next_versions(incoming, spec, run_ts, history.filter(F.col(VALID_TO).isNull())))


def snapshot_parts(incoming: DataFrame, spec: SnapshotSpec, run_ts: dt.datetime, root: str) -> Stored:
    """The next version of a stored history in two parts: open rows are written
    anew, rows that the run closes are a part of their own, and parts closed by
    earlier runs are carried without being read."""
    spark = incoming.sparkSession
    stored = open_table(spark, root)
    if stored is None:
        rows, carried, version = next_versions(incoming, spec, run_ts), {}, 1
    else:
        latest = max((t for c in (VALID_FROM, VALID_TO) for t in stored.bounds(c)[1:] if t), default=None)
        if latest is not None and latest >= run_ts:
            raise ValueError(f"snapshot: run at {run_ts} is not later than the history")
        opened, version = stored.frame(stored.folders(lambda v: v[PART] == OPEN)), stored.version + 1
        rows = next_versions(incoming, spec, run_ts, opened.drop(PART))
        closed = stored.folders(lambda v: v[PART] != OPEN)
        carried = {f: stored.parts[f] for f in closed}
        if closed and not same_types(stored, rows.schema):
            old = stored.frame(closed).drop(PART)
            rows, carried = rows.unionByName(old.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])), {}
    part = F.when(F.col(VALID_TO).isNull(), F.lit(OPEN)).otherwise(F.lit(f"closed-{version}"))
    return write_parts(rows.withColumn(PART, part), root, [PART], carried, [VALID_FROM, VALID_TO])


def read_history(spark: SparkSession, root: str) -> DataFrame | None:
    stored = open_table(spark, root)
    return None if stored is None else stored.frame().drop(PART)


def intersect_validity(from_a: Column, to_a: Column, from_b: Column, to_b: Column) -> tuple[Column, Column]:
    """[greatest(from), least(to)) with NULL meaning open-ended.

    ``greatest`` skips NULL, so an unmatched right side keeps the left start.
    """
    sentinel = _ts(OPEN_END)
    valid_from = F.greatest(from_a, from_b)
    to_internal = F.least(F.coalesce(to_a, sentinel), F.coalesce(to_b, sentinel))
    valid_to = F.when(to_internal == sentinel, _ts(None)).otherwise(to_internal)
    return valid_from, valid_to


def overlaps(from_a: Column, to_a: Column, from_b: Column, to_b: Column) -> Column:
    sentinel = _ts(OPEN_END)
    return F.greatest(from_a, from_b) < F.least(F.coalesce(to_a, sentinel), F.coalesce(to_b, sentinel))
