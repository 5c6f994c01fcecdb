"""Behaviour switches for the places where the source SQL is ambiguous or wrong.

Every builder takes one frozen ``Semantics``; the defaults are the repaired
behaviour, the ``literal`` values reproduce the source SQL as written.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source models.
COMPLETED_LITERAL = "Completed"
COMPLETED_UPPER = "COMPLETED"
TYPE_FIXED = "Fixed"
TYPE_TM = "Time and Material"
DEFAULT_CALENDAR_START = dt.date(2024, 1, 1)
DEFAULT_CALENDAR_END = dt.date(2025, 12, 31)
WATERMARK_FLOOR = dt.datetime(1900, 1, 1)


@dataclass(frozen=True)
class Semantics:
    # "intent": staged status is upper case, compare with COMPLETED.
    # "literal": compare with 'Completed' as the source facts do (never true).
    status_match: str = "intent"
    # "current": facts join only open dimension rows; "all": every version.
    dim_version: str = "current"
    # "literal": percent_complete divides as stored (0-100);
    # "fraction": divide by percent/100 in the project fact.
    percent_scale: str = "literal"
    # history-pair dimensions keep only overlapping version pairs.
    overlap_only: bool = True
    # finance fact rows: "expense" (unit-months with project expense) or
    # "any" (every unit-month that has any measure).
    anchor: str = "expense"
    # NULL last_update ordering in the latest-row window; the source dialect
    # sorts NULLs first under DESC.
    latest_nulls: str = "first"
    # A stored fact without any dated row: "full" loads everything; "nothing"
    # loads nothing, as a comparison with a NULL cutoff does in the source.
    empty_target: str = "full"
    calendar_start: dt.date = DEFAULT_CALENDAR_START
    calendar_end: dt.date = DEFAULT_CALENDAR_END
    # stands in for CURRENT_DATE; builders never read the clock.
    as_of: dt.date = dt.date(2025, 12, 31)

    def with_(self, **kw) -> "Semantics":
        return replace(self, **kw)

    def month_bounds(self, since: dt.date | None = None) -> tuple[dt.date, dt.date]:
        """First and last day whose month start is in the calendar (and not
        before ``since``): the same test on the raw date, which scans push down."""
        start, end = self.calendar_start, self.calendar_end
        first = start if start.day == 1 else (start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        last = end.replace(day=calendar.monthrange(end.year, end.month)[1])
        return (max(first, since) if since else first), last

    # --- predicates shared by the measures -------------------------------
    def completed(self, status: Column) -> Column:
        target = COMPLETED_UPPER if self.status_match == "intent" else COMPLETED_LITERAL
        return status == F.lit(target)

    def not_completed(self, status: Column) -> Column:
        target = COMPLETED_UPPER if self.status_match == "intent" else COMPLETED_LITERAL
        return status != F.lit(target)

    def percent_divisor(self, pct: Column) -> Column:
        if self.percent_scale == "fraction":
            return pct / F.lit(100)
        return pct


DRIVER_SEMANTICS = Semantics(
    calendar_start=dt.date(1995, 1, 1),
    calendar_end=dt.date(2001, 12, 31),
    as_of=dt.date(2001, 12, 31),
)
"""Parameters for the driver test tables (dates 1995-2001)."""

SNAPSHOT_TS = dt.datetime(2001, 12, 31, 0, 0, 0)
"""Run timestamp of the single snapshot taken over the driver tables."""
