"""End-to-end build in a fixed order: staging -> snapshots -> reductions ->
dimensions -> facts -> checks.

Every layer is written as a new version under ``root`` (a shared folder: by
default ``<spark.checkpoint.dir>/practica``) and read back before the next layer
uses it. That cuts the lineage at each layer, so a lost executor recomputes at
most one layer from stored files, and no job ever overwrites the table it reads.
Histories, reductions and facts are made of parts: a run writes what it changes
and refers to the rest. What no kept version refers to is deleted at the end.

Layout::

    <root>/snapshots/<name>/v=<n>     SCD2 histories (part=open, part=closed-<n>)
    <root>/reduced/<name>/v=<n>       monthly time entries and expenses (shared by facts)
    <root>/dims/<name>/v=<n>          mart dimensions
    <root>/facts/<name>/v=<n>         facts (partitioned by month)
    <root>/facts/hr_*_bridge/v=<n>    HR bridges (full rebuild)
    <root>/checks/v=<n>               declared-test summary
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.functions.keys import ntz
from practica.operators.incremental import incremental_refresh, keep_last, last_update_watermark, read_current, write_version
from practica.operators.parts import Stored, open_table, prune
from practica.operators.reductions import REDUCTIONS, as_events, maintain
from practica.operators.scd2 import SNAPSHOTS, read_history, snapshot_parts
from practica.operators.staging import stage_all
from practica.plans import facts
from practica.plans.marts import Marts, build_marts
from practica.semantics import Semantics
from practica.session import shared_dir
from practica.sources.tables import Sources, Staged

DELTA_KEYS = 10_000         # updated projects (or their deliverables) that are read by key
KEEP = 2                    # versions of each table that stay readable
# Dates outside are stand-ins for an unknown or open date.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2199, 12, 31)

DIMENSIONS = ("business_unit", "client", "consultant", "project", "deliverable", "title_history")

# fact name -> (builder, merge key, month column that the key is made of, cutoff column)
FACTS = {
    "finance": (facts.finance_fact, "row_key", "date", "date"),
    "business_dev": (facts.business_dev_fact, "client_feedback_key", "date", "date"),
    "project": (facts.project_fact, "row_key", "date", "last_update"),
    "hr_utilization": (facts.hr_utilization, "HR_record_key", "snapshot_month", "date"),
}
BRIDGES = {
    "hr_deliverable_bridge": facts.hr_deliverable_bridge,
    "hr_client_bridge": facts.hr_client_bridge,
}


@dataclass
class BuildResult:
    root: str
    paths: dict[str, str]
    checks: DataFrame


def default_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/practica"


def reduce_events(spark: SparkSession, st: Staged, root: str, full: bool = False) -> tuple[Staged, dict[str, Stored]]:
    """Shared measure inputs (SURVEY §4 'common work'): the monthly sums of time
    entries and expenses, brought up to date (``operators.reductions``). Each fact
    reads them instead of the raw events. Exact: sums of sums, NULL only where
    every input is NULL; the month stands in for the date, which the measures
    only ever truncate."""
    kept = {name: maintain(spark, getattr(st, name), r, f"{root}/reduced/{name}", full)
            for name, r in REDUCTIONS.items()}
    return st.replace(**{name: as_events(kept[name].frame(), r, getattr(st, name))
                         for name, r in REDUCTIONS.items()}), kept


# Staged dates that a fact's rows are dated by.
FACT_DATES = (("time_entry", "work_date"), ("project_expense", "expense_date"), ("deliverable", "due_date"),
              ("non_billable_hours", "month_start_date"), ("project", "last_update"),
              ("project", "planned_start_date"), ("project", "actual_start_date"),
              ("project", "actual_end_date"))


def _whole_years(bounds: list, as_of: dt.date) -> tuple[dt.date, dt.date]:
    days = [d for d in bounds if d] + [as_of]
    return dt.date(min(days).year, 1, 1), dt.date(max(days).year, 12, 31)


def _plausible(day: Column) -> Column:
    """Not a stand-in for an unknown or open date (such as 9999-12-31)."""
    return day.between(F.lit(FIRST_DAY), F.lit(LAST_DAY))


def _dates_of() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for name, col in FACT_DATES:
        out.setdefault(name, []).append(col)
    return out


def calendar_of(st: Staged, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Whole years around ``as_of`` and every plausible date in ``FACT_DATES``:
    one job for each relation."""
    found = []
    for name, cols in _dates_of().items():
        days = [F.when(_plausible(F.to_date(c)), F.to_date(c)) for c in cols]
        found += getattr(st, name).agg(*[f(d) for d in days for f in (F.min, F.max)]).first()
    return _whole_years(found, as_of)


def stored_calendar(spark: SparkSession, root: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Whole years around ``as_of`` and the dates of the stored facts."""
    found = []
    for name in FACTS:
        stored = read_current(spark, f"{root}/facts/{name}")
        found += stored.agg(F.min("date"), F.max("date")).first() if stored is not None else []
    return _whole_years(found, as_of)


def outside_calendar(st: Staged, sem: Semantics) -> dict[str, int]:
    """How many dates of each column in ``FACT_DATES`` the calendar leaves out,
    stand-in dates included: one job for each relation."""
    out = {}
    for name, cols in _dates_of().items():
        days = [~F.to_date(c).between(F.lit(sem.calendar_start), F.lit(sem.calendar_end)) for c in cols]
        counts = getattr(st, name).agg(*[F.count_if(d) for d in days]).first()
        out.update({f"{name}.{c}": n for c, n in zip(cols, counts) if n})
    return out


def snapshot_layer(spark: SparkSession, st: Staged, root: str, run_ts: dt.datetime) -> dict[str, str]:
    return {name: snapshot_parts(getattr(st, name), spec, run_ts, f"{root}/snapshots/{name}").path
            for name, spec in SNAPSHOTS.items()}


def dimension_layer(spark: SparkSession, root: str, sem: Semantics) -> tuple[Marts, dict[str, str]]:
    histories = {n: read_history(spark, f"{root}/snapshots/{n}") for n in SNAPSHOTS}
    marts = build_marts(histories, sem)
    paths = {n: write_version(getattr(marts, n), f"{root}/dims/{n}") for n in DIMENSIONS}
    stored = {n: read_current(spark, f"{root}/dims/{n}") for n in DIMENSIONS}
    return Marts(histories=histories, **stored), paths


def fact_layer(spark: SparkSession, st: Staged, marts: Marts, root: str, sem: Semantics,
               reduced: dict[str, Stored] | None = None) -> dict[str, str]:
    """Each fact merged from its own cutoff on. Cutoffs are read from manifests:
    the facts' own, and the expense reduction's months for I4."""
    paths = {}
    for name, (builder, key, month, cutoff) in FACTS.items():
        known, inputs = {}, st
        if name == "finance" and reduced is not None:
            known["latest_expense"] = latest_month(reduced["project_expense"], sem)
        if name == "project" and reduced is not None:
            inputs = inputs_of_updated(st, reduced, open_table(spark, f"{root}/facts/{name}"))
        paths[name] = incremental_refresh(
            spark, f"{root}/facts/{name}",
            lambda target, b=builder, st=inputs, known=known: b(st, marts, sem, target=target, **known),
            key, [month], [cutoff] if cutoff != month else []).path
    return paths


def inputs_of_updated(st: Staged, reduced: dict[str, Stored], target: Stored | None) -> Staged:
    """The reductions narrowed to the files that may hold entries and expenses
    of projects updated since the stored fact. With more than ``DELTA_KEYS``
    projects or deliverables updated (or no fact yet) all files are read."""
    if target is None:
        return st
    updated = (st.project.filter(F.col("last_update") > ntz(last_update_watermark(target)))
               .select("project_id").filter("project_id is not null").distinct())
    projects = [r[0] for r in updated.limit(DELTA_KEYS + 1).collect()]
    if len(projects) > DELTA_KEYS:
        return st
    own = st.deliverable.filter(F.col("project_id").isin(projects)) if projects else st.deliverable.limit(0)
    deliverables = [r[0] for r in own.select("deliverable_id").filter("deliverable_id is not null").distinct()
                    .limit(DELTA_KEYS + 1).collect()]
    if len(deliverables) > DELTA_KEYS:
        return st
    keys = {"time_entry": deliverables, "project_expense": projects}
    return st.replace(**{name: as_events(reduced[name].frame(keys=keys[name]), r, getattr(st, name))
                         for name, r in REDUCTIONS.items()})


def latest_month(reduced: Stored, sem: Semantics) -> dt.date | None:
    """The latest stored month in the calendar; no job."""
    date = reduced.partition_by[0]
    first, last = sem.month_bounds()
    inside = reduced.folders(lambda v: v[date] is not None and first <= v[date] <= last)
    return reduced.bounds(date, inside)[1]


def bridge_layer(spark: SparkSession, st: Staged, marts: Marts, root: str,
                 sem: Semantics) -> dict[str, str]:
    """The HR many-to-many links, rebuilt in full each run (no unique key)."""
    return {name: write_version(fn(st, marts, sem), f"{root}/facts/{name}")
            for name, fn in BRIDGES.items()}


def stored_relations(spark: SparkSession, root: str, sem: Semantics) -> dict[str, DataFrame]:
    """Current stored versions under the names the declared tests use."""
    from practica.operators.calendar import date_dim
    cal = date_dim(spark, sem.calendar_start, sem.calendar_end)
    dim = {n: read_current(spark, f"{root}/dims/{n}") for n in DIMENSIONS}
    fact = {n: read_current(spark, f"{root}/facts/{n}") for n in (*FACTS, *BRIDGES)}
    return {
        "bd_date_dim": cal, "hr_date_dim": cal, "project_date_dim": cal,
        "bd_business_unit_dim": dim["business_unit"].withColumnRenamed("unitkey", "business_unit_key"),
        "businessunit_dim": dim["business_unit"], "client_dim": dim["client"],
        "consultant_dim": dim["consultant"], "title_history_dim": dim["title_history"], "deliverable_dim": dim["deliverable"],
        "project_dim": dim["project"], "business_dev_fact": fact["business_dev"],
        "hr_utilization": fact["hr_utilization"], "project_fact": fact["project"],
        "hr_deliverable_bridge": fact["hr_deliverable_bridge"],
        "hr_client_bridge": fact["hr_client_bridge"],
    }


def check_layer(spark: SparkSession, root: str, sem: Semantics) -> DataFrame:
    """Every declared data test over the stored marts; summary stored too."""
    from practica.plans.check_catalog import run_catalog
    write_version(run_catalog(stored_relations(spark, root, sem)), f"{root}/checks")
    return read_current(spark, f"{root}/checks")


def prune_layers(spark: SparkSession, root: str, keep: int = KEEP) -> list[str]:
    """Retention: what none of the last ``keep`` versions of a table refers to."""
    made_of_parts = [f"snapshots/{n}" for n in SNAPSHOTS] + [f"reduced/{n}" for n in REDUCTIONS] + [f"facts/{n}" for n in FACTS]
    in_full = [f"dims/{n}" for n in DIMENSIONS] + [f"facts/{n}" for n in BRIDGES] + ["checks"]
    return [p for n in made_of_parts for p in prune(spark, f"{root}/{n}", keep)] + [
        p for n in in_full for p in keep_last(spark, f"{root}/{n}", keep)]


def run_build(spark: SparkSession, sources: Sources, run_ts: dt.datetime, sem: Semantics | None = None,
              root: str | None = None, full: bool = False, keep: int = KEEP) -> BuildResult:
    """One scheduled run: snapshot the sources at ``run_ts``, bring the reductions
    up to date (``full``: from all events), rebuild the dimensions, merge the
    facts incrementally, run the checks, delete what the last ``keep`` versions
    don't need. Without ``sem`` the calendar is taken from the data."""
    root = root or default_root(spark)
    st = stage_all(sources)
    if sem is None:
        start, end = calendar_of(st, run_ts.date())
        sem = Semantics(as_of=run_ts.date(), calendar_start=start, calendar_end=end)
    paths = {f"snapshot/{k}": v for k, v in snapshot_layer(spark, st, root, run_ts).items()}
    marts, dim_paths = dimension_layer(spark, root, sem)
    paths.update({f"dim/{k}": v for k, v in dim_paths.items()})
    events, reduced = reduce_events(spark, st, root, full)
    paths.update({f"reduced/{k}": v.path for k, v in reduced.items()})
    paths.update({f"fact/{k}": v for k, v in fact_layer(spark, events, marts, root, sem, reduced).items()})
    paths.update({f"fact/{k}": v for k, v in bridge_layer(spark, events, marts, root, sem).items()})
    checks = check_layer(spark, root, sem)
    prune_layers(spark, root, keep)
    return BuildResult(root, paths, checks)
