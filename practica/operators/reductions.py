"""Monthly partial sums of time entries and expenses, kept from run to run.

Every measure over these two largest inputs is a sum by month, so they are
reduced once to sums by (keys, month), stored with a partition for each month. A
later run reads only what may have changed:

* all events from the lookback on (a month before the latest stored month, as
  the facts' own rule): those months are summed anew, so edits in them count;
* late events, dated before it but numbered above the highest number seen: their
  sums are added to those of their months.

Both are tests on the raw date and number, so they reach the scan; months that
are touched by neither are carried as they are. Event numbers grow in the order
of arrival; edits of events before the lookback are seen by a full refresh only.
Without usable numbers (a NULL among them) every run is a full refresh. A month
whose events are all gone from the lookback disappears; a NULL date is a month of
its own. Sums keep the type of the first reduction.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.functions.keys import month_start
from practica.operators import parts


@dataclass(frozen=True)
class Reduction:
    keys: tuple[str, ...]
    date: str
    number: str
    value: str
    cluster: str            # the key that few files are read by


# Staged relation -> its reduction.
REDUCTIONS = {
    "time_entry": Reduction(("consultant_id", "deliverable_id"), "work_date", "record_id", "hours", "deliverable_id"),
    "project_expense": Reduction(("project_id", "is_billable"), "expense_date", "record_id", "amount", "project_id"),
}
LAST, UNNUMBERED = "last_number", "unnumbered"


def reduce(events: DataFrame, r: Reduction) -> DataFrame:
    """(date = month, keys, sum, highest number, events without a number)."""
    return (events.groupBy(month_start(r.date).alias(r.date), *r.keys)
            .agg(F.sum(r.value).alias(r.value), F.max(r.number).alias(LAST),
                 F.count_if(F.col(r.number).isNull()).alias(UNNUMBERED)))


def _resum(rows: DataFrame, r: Reduction, like: DataFrame) -> DataFrame:
    """Sums of partial sums, in the columns and types of ``like``."""
    again = rows.groupBy(r.date, *r.keys).agg(F.sum(r.value).alias(r.value), F.max(LAST).alias(LAST),
                                              F.sum(UNNUMBERED).alias(UNNUMBERED))
    return again.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def lookback(stored: parts.Stored, r: Reduction) -> dt.date | None:
    """First day of the month before the latest stored one."""
    latest = stored.bounds(r.date)[1]
    return None if latest is None else (latest.replace(day=1) - dt.timedelta(days=1)).replace(day=1)


def _late(r: Reduction, since: dt.date, number: int) -> Column:
    day: Column = F.col(r.date)
    return (F.col(r.number) > F.lit(number)) & ((day < F.lit(since)) | day.isNull())


def changes(events: DataFrame, r: Reduction, since: dt.date, number: int) -> tuple[DataFrame, DataFrame]:
    """(events from ``since`` on, late ones before it)."""
    return events.filter(F.col(r.date) >= F.lit(since)), events.filter(_late(r, since, number))


def maintain(spark: SparkSession, events: DataFrame, r: Reduction, root: str, full: bool = False) -> parts.Stored:
    """The next version of the reduction of ``events`` stored at ``root``."""
    stored = None if full else parts.open_table(spark, root)
    statistics = [LAST, UNNUMBERED]
    if stored is not None and stored.parts:
        since, number = lookback(stored, r), stored.bounds(LAST)[1]
        if since is not None and number is not None and not stored.bounds(UNNUMBERED)[1]:
            # events without a number come along: one reading finds them and the late ones
            batch = f"{root.rstrip('/')}/_late/{stored.version}"
            reduce(events.filter(F.col(r.number).isNull() | _late(r, since, number)), r).write.mode("overwrite").parquet(batch)
            late = spark.read.parquet(batch)
            found = late.groupBy(r.date).agg(F.max(UNNUMBERED).alias("n")).collect()
            if not any(row["n"] for row in found):
                months = {row[0] for row in found}
                fresh = reduce(changes(events, r, since, number)[0], r)
                touched = stored.folders(lambda v: v[r.date] in months)
                kept = stored.folders(lambda v: v[r.date] not in months and (v[r.date] is None or v[r.date] < since))
                added = _resum(stored.frame(touched).unionByName(late), r, stored.frame([]))
                rows = added.unionByName(fresh.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema.fields]))
                new = parts.write_parts(rows, root, [r.date], {f: stored.parts[f] for f in kept}, statistics, r.cluster)
                parts.drop_folder(spark, batch)
                return new
            parts.drop_folder(spark, batch)
    return parts.write_parts(reduce(events, r), root, [r.date], statistics=statistics, cluster=r.cluster)


def as_events(reduced: DataFrame, r: Reduction, like: DataFrame) -> DataFrame:
    """The reduction under the columns of the staged relation: one event for each
    sum, dated by its month, without a number."""
    return reduced.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name == r.number else F.col(f.name)
                            for f in like.schema.fields])
