"""Histories and dimensions assembled from staged relations.

``Marts`` bundles what the fact builders join: the SCD2 histories, the mart
dimensions over them and the calendar bounds.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from practica.operators import dims
from practica.operators.scd2 import SNAPSHOTS, scd2_snapshot
from practica.semantics import Semantics
from practica.sources.tables import LazyDict, Staged, _Lazy


@dataclass
class Marts(_Lazy):
    histories: dict[str, DataFrame]
    business_unit: DataFrame  # key column "unitkey"
    client: DataFrame
    consultant: DataFrame
    project: DataFrame
    deliverable: DataFrame
    title_history: DataFrame


def snapshot_all(st: Staged, run_ts: dt.datetime,
                 histories: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Take one snapshot of the seven histories (first run when ``histories`` is None)."""
    staged = {name: name for name in SNAPSHOTS}
    def take(name):
        return lambda: scd2_snapshot(getattr(st, staged[name]), SNAPSHOTS[name], run_ts,
                                     None if histories is None else histories[name])
    return LazyDict({name: take(name) for name in SNAPSHOTS})


def build_marts(histories: dict[str, DataFrame], sem: Semantics = Semantics()) -> Marts:
    h = histories
    return Marts(
        histories=h,
        business_unit=lambda: dims.business_unit_dim(h["businessunit"]),
        client=lambda: dims.client_dim(h["client"]),
        consultant=lambda: dims.consultant_dim(h["consultant"]),
        project=lambda: dims.project_dim(h["project"]),
        deliverable=lambda: dims.deliverable_dim(h["deliverable"], h["project"], sem),
        title_history=lambda: dims.title_history_dim(h["title_assignment"], h["title"], sem),
    )


def in_calendar(c: Column, sem: Semantics) -> Column:
    """The calendar holds every day in [start, end] exactly once, so a join
    to it on one date column is a range test: a left join yields the date or
    NULL, an inner join keeps the row iff the date is inside."""
    return c.between(F.lit(sem.calendar_start), F.lit(sem.calendar_end))


def calendar_date(c: Column, sem: Semantics) -> Column:
    return F.when(in_calendar(c, sem), c)
