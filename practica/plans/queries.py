"""Registered queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query derives the 14 operational sources from the driver tables in
``sf_dir`` (``sources.driver_tables``) and runs the library operator over the
whole of them. Parameters for those tables (calendar 1995-2001, as-of date,
snapshot time) are in ``DRIVER_SEMANTICS`` / ``SNAPSHOT_TS``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.functions.keys import month_start, ntz, project_row_key, surrogate_key, ts_to_key
from practica.operators import measures as m
from practica.operators import quality as q
from practica.operators.calendar import date_dim_between
from practica.operators.incremental import incremental_refresh, read_current, write_version
from practica.operators.parts import dealt_by, write_parts
from practica.operators.reductions import REDUCTIONS, maintain
from practica.operators.scd2 import SNAPSHOTS, read_history, scd2_snapshot, snapshot_parts
from practica.operators.staging import (stage_all, stage_deliverable, stage_project_expense,
                                        stage_time_entry)
from practica.plans import facts
from practica.plans.marts import Marts, build_marts, snapshot_all
from practica.session import materialize, shared_dir
from practica.semantics import DRIVER_SEMANTICS, SNAPSHOT_TS, Semantics
from practica.sources.driver_tables import deliverable, read_driver, sources_from_driver
from practica.sources.schemas import read_sources
from practica.sources.tables import Staged

# Fixed parameters of the derived test scenarios (shared with the oracle SQL).
# the two snapshot runs of the client and two-snapshot scenarios
CLIENT_RUN1_TS = dt.datetime(2001, 6, 30, 0, 0, 0)
CLIENT_RUN2_TS = dt.datetime(2001, 12, 31, 0, 0, 0)
LATEST_COPY_EVERY = 5        # projects with id % 5 = 0 get a later copy
LATEST_COPY_SHIFT_DAYS = 30
MERGE_SPLIT_MONTH = dt.date(2000, 1, 1)   # target holds expense before this month
PROJECT_SPLIT_TS = dt.datetime(1999, 1, 1)  # the stored project fact's watermark
PROJECT_SPLIT_END = dt.datetime(1999, 2, 1)


class Context:
    """Sources, staging, histories and dimensions of one driver directory,
    each built on first use so a query only plans what it reads."""

    def __init__(self, spark: SparkSession, sf_dir: str, sem: Semantics = DRIVER_SEMANTICS):
        self.spark, self.sf_dir, self.sem = spark, sf_dir, sem

    @cached_property
    def st(self) -> Staged:
        return stage_all(sources_from_driver(self.spark, self.sf_dir))

    @cached_property
    def keyed(self) -> Staged:
        """The staged relations as histories take them."""
        lineitem = read_driver(self.spark, self.sf_dir, "lineitem")
        return self.st.replace(deliverable=lambda: stage_deliverable(deliverable(lineitem, keyed=True)))

    @cached_property
    def marts(self) -> Marts:
        return build_marts(snapshot_all(self.keyed, SNAPSHOT_TS), self.sem)

    def fact(self, builder, sem: Semantics | None = None) -> DataFrame:
        """A full-refresh fact plan, built once per (builder, semantics)."""
        sem = sem or self.sem
        memo = self.__dict__.setdefault("_facts", {})
        key = (builder.__name__, sem)
        if key not in memo:
            memo[key] = builder(self.st, self.marts, sem)
        return memo[key]


def _q(fn: Callable[[Context], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Context(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ------------------------------------------------------------- staging/keys
def staging_project(c: Context) -> DataFrame:
    return c.st.project


def _staged(field: str):
    def q(c: Context) -> DataFrame:
        return getattr(c.st, field)
    q.__name__ = f"staging_{field}"
    q.__doc__ = f"S1-S14: the staged {field} relation."
    return q


STAGED_FIELDS = ("businessunit", "client", "client_feedback", "consultant", "time_entry",
                 "title_assignment", "deliverable", "indirect_cost", "non_billable_hours", "payroll",
                 "billing_rate", "project_expense", "title")


def calendar(c: Context) -> DataFrame:
    """Calendar spanning whole years around every order and ship date."""
    o = read_driver(c.spark, c.sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    li = read_driver(c.spark, c.sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    bounds = o.unionByName(li).agg(F.trunc(F.min("d"), "year").alias("start"),
                                   F.add_months(F.trunc(F.max("d"), "year"), 12).alias("end_x"))
    bounds = bounds.select("start", F.date_sub("end_x", 1).alias("end"))
    return date_dim_between(bounds)


def surrogate_keys(c: Context) -> DataFrame:
    p = c.st.project
    return p.select("project_id",
                    surrogate_key(F.col("project_id"), ts_to_key(F.col("last_update"))).alias("version_key"),
                    surrogate_key(F.col("project_name"), F.col("status"), F.col("price"))
                    .alias("text_key"),
                    surrogate_key(F.col("unit_id"), ts_to_key(F.col("planned_start_date")))
                    .alias("date_key"))


def project_row_keys(c: Context) -> DataFrame:
    p = c.st.project
    return p.select("project_id", project_row_key(F.col("project_id"), month_start("last_update"))
                    .alias("row_key"))


# ------------------------------------------------------------------ measures
def fixed_revenue_month(c): return m.fixed_revenue_month(c.st, c.sem)
def expense_revenue_month(c): return m.expense_revenue_month(c.st)
def consultant_revenue_month(c): return m.consultant_revenue_month(c.st)
def satisfaction_month(c): return m.satisfaction_month(c.st)
def fixed_incomplete(c): return m.fixed_incomplete_month(c.st, c.sem)
def tm_incomplete(c): return m.tm_incomplete_month(c.st, c.sem)
def expense_unit_month(c): return m.expense_unit_month(c.st)
def direct_cost_unit_month(c): return m.direct_cost_unit_month(c.st)
def indirect_cost_unit_month(c): return m.indirect_cost_unit_month(c.st)
def revenue_per_project(c): return m.revenue_per_project(c.st, c.sem)
def unit_revenue(c): return m.unit_revenue_month(c.st, c.sem)
def consultant_hours(c): return m.consultant_hours_month(c.st)
def project_hours(c): return m.project_hours_month(c.st)
def project_expense_month(c): return m.project_expense_month(c.st)
def consultant_cost_month(c): return m.consultant_cost_month(c.st)
def activity_spine(c): return m.activity_spine(c.st, c.sem)


def latest_project(c: Context) -> DataFrame:
    """W1 over staged projects plus a later copy of every fifth project."""
    p = c.st.project
    later = (p.filter(F.col("project_id") % LATEST_COPY_EVERY == 0)
             .withColumn("last_update", F.col("last_update") + F.expr(
                 f"interval {LATEST_COPY_SHIFT_DAYS} days"))
             .withColumn("percent_complete", F.least(F.col("percent_complete") + 1,
                                                     F.lit(100)).cast("decimal(5,2)")))
    return m.latest_project(p.unionByName(later), c.sem)


# --------------------------------------------------------------- history
def client_second_state(st: Staged) -> DataFrame:
    """Run-2 input derived from the clients: every third phone changes, every
    eleventh client is missing, clients with id % 13 = 0 are new (absent in run 1)."""
    cl = st.client
    return (cl.filter(F.col("client_id") % 11 != 0)
            .withColumn("phone_number", F.when(F.col("client_id") % 3 == 0,
                                               F.concat(F.col("phone_number"), F.lit(" x9")))
                        .otherwise(F.col("phone_number"))))


def scd2_client_two_runs(c: Context) -> DataFrame:
    spec = SNAPSHOTS["client"]
    run1 = c.st.client.filter(F.col("client_id") % 13 != 0)
    h1 = scd2_snapshot(run1, spec, CLIENT_RUN1_TS)
    return scd2_snapshot(client_second_state(c.st), spec, CLIENT_RUN2_TS, h1)


# The column that a second run changes in every third row of each history.
CHANGED = {
    "businessunit": "business_unit_name", "client": "phone_number", "consultant": "contact",
    "title_assignment": "title_id", "deliverable": "name", "project": "project_name", "title": "title_name",
}


def scd2_all_two_runs(c: Context) -> DataFrame:
    """H4-H11 over all seven histories: keys with key % 13 = 0 are new in the
    second run, keys with key % 11 = 0 are missing from it, and every third
    key's row has changed."""
    parts = []
    for name, spec in SNAPSHOTS.items():
        rows, key, col = getattr(c.st, name), F.col(spec.key), F.col(CHANGED[name])
        new = (F.coalesce(col, F.lit(0)) + 1 if name == "title_assignment"
               else F.concat(F.coalesce(col, F.lit("")), F.lit(" x9")))
        second = rows.filter(key % 11 != 0).withColumn(CHANGED[name], F.when(key % 3 == 0, new).otherwise(col))
        history = scd2_snapshot(rows.filter(key % 13 != 0), spec, CLIENT_RUN1_TS)
        parts.append(scd2_snapshot(second, spec, CLIENT_RUN2_TS, history).select(
            F.lit(name).alias("history"), key.cast("long").alias("key_id"), "valid_from", "valid_to",
            F.md5(F.concat_ws("|", *[F.coalesce(F.col(x).cast("string"), F.lit("~")) for x in spec.check_cols]))
            .alias("versioned")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def staging_text_dates(c: Context) -> DataFrame:
    """S5, S7 and S13 where the source stores its date as text."""
    def as_text(df, col):
        return df.withColumn(col, F.col(col).cast("string"))
    src = sources_from_driver(c.spark, c.sf_dir)
    parts = [
        ("time_entry", stage_time_entry(as_text(src.consultant_deliverable, "DATE")), "record_id", "work_date"),
        ("deliverable", stage_deliverable(as_text(src.deliverable, "DUE_DATE")), "deliverable_id", "due_date"),
        ("project_expense", stage_project_expense(as_text(src.project_expense, "date")), "record_id",
         "expense_date"),
    ]
    return reduce(lambda a, b: a.unionByName(b), [
        df.select(F.lit(name).alias("source"), F.col(key).alias("key_id"), F.col(date).alias("date"))
        for name, df, key, date in parts])


def two_snapshot_marts(c: Context) -> Marts:
    """Histories from two runs: every seventh project's price changes at the
    second run, so its history (and the pairs built on it) has two versions."""
    h1 = snapshot_all(c.keyed, CLIENT_RUN1_TS)
    p = c.st.project
    changed = p.withColumn("price", F.when(F.col("project_id") % 7 == 0, F.col("price") + 1)
                           .otherwise(F.col("price")).cast("decimal(18,2)"))
    return build_marts(snapshot_all(c.keyed.replace(project=changed), CLIENT_RUN2_TS, h1), c.sem)


def dim_deliverable_two_versions(c):
    return two_snapshot_marts(c).deliverable


def fact_project_all_versions(c):
    return facts.project_fact(c.st, two_snapshot_marts(c), c.sem.with_(dim_version="all"))


def dim_project(c): return c.marts.project
def dim_client(c): return c.marts.client
def dim_business_unit(c): return c.marts.business_unit
def dim_consultant(c): return c.marts.consultant
def dim_deliverable(c): return c.marts.deliverable
def dim_title_history(c): return c.marts.title_history


# ------------------------------------------------------------------ facts
def fact_finance(c): return c.fact(facts.finance_fact)
def fact_finance_any_anchor(c): return facts.finance_fact(c.st, c.marts, c.sem.with_(anchor="any"))
def fact_project_fraction(c): return facts.project_fact(c.st, c.marts, c.sem.with_(percent_scale="fraction"))
def tm_incomplete_literal_status(c):
    return m.tm_incomplete_month(c.st, c.sem.with_(status_match="literal"))
def fact_business_dev(c): return c.fact(facts.business_dev_fact)
def fact_project(c): return c.fact(facts.project_fact)
def hr_utilization(c): return c.fact(facts.hr_utilization)
def hr_deliverable_bridge(c): return c.fact(facts.hr_deliverable_bridge)
def hr_client_bridge(c): return c.fact(facts.hr_client_bridge)


def _staged_with(st: Staged, **repl) -> Staged:
    return st.replace(**repl)


def _folder(c: Context, name: str) -> str:
    return f"{shared_dir(c.spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _merged(c: Context, builder, before: Staged, now: Staged, key: str, month: str = "date",
            cutoff: str = "date", stored=lambda fact: fact) -> DataFrame:
    """The fact of ``before``, stored in parts by month, after an incremental run
    over ``now``, as the build stores and merges it."""
    root = _folder(c, "merged")
    statistics = [cutoff] if cutoff != month else []
    early = builder(before, c.marts, c.sem, dealt=lambda rows: dealt_by(rows, "month"))
    write_parts(stored(early), root, [month], statistics=statistics, dealt=True)
    return incremental_refresh(c.spark, root, lambda target: builder(now, c.marts, c.sem, target=target),
                               key, [month], statistics).frame()


def merge_upsert_fact(c: Context) -> DataFrame:
    """I1 + I4: the finance fact built from expenses before 2000-01 is the
    stored target; an incremental run over all data merges on row_key. I4 looks
    back one month from the batch's own latest month, so older months that the
    target lacks stay missing, as in the source."""
    early = _staged_with(c.st, project_expense=c.st.project_expense.filter(
        F.col("expense_date") < F.lit(MERGE_SPLIT_MONTH)))
    return _merged(c, facts.finance_fact, early, c.st, "row_key")


def merge_hr_utilization(c: Context) -> DataFrame:
    """I1 + I3: HR utilization stored from hours before 2000-01; the
    incremental run reloads from one month before the stored maximum date."""
    early = _staged_with(c.st, non_billable_hours=c.st.non_billable_hours.filter(
        F.col("month_start_date") < F.lit(MERGE_SPLIT_MONTH)))
    return _merged(c, facts.hr_utilization, early, c.st, "HR_record_key", "snapshot_month")


def merge_schema_change(c: Context) -> DataFrame:
    """The stored HR fact has a column that the batch dropped and lacks one
    that it adds; stored rows lose the first and have NULL in the second."""
    early = _staged_with(c.st, non_billable_hours=c.st.non_billable_hours.filter(
        F.col("month_start_date") < F.lit(MERGE_SPLIT_MONTH)))
    return _merged(c, facts.hr_utilization, early, c.st, "HR_record_key", "snapshot_month",
                   stored=lambda f: f.drop("billable_hours_percentage").withColumn("legacy_note", F.lit("x")))


def merge_business_dev(c: Context) -> DataFrame:
    """I1 + I3 on the business-development fact: stored from expenses before
    2000-01; the batch reloads from one month before the stored maximum date,
    so older late rows stay as stored (the rule's documented limit)."""
    early = _staged_with(c.st, project_expense=c.st.project_expense.filter(
        F.col("expense_date") < F.lit(MERGE_SPLIT_MONTH)))
    return _merged(c, facts.business_dev_fact, early, c.st, "client_feedback_key")


def cutoff_last_update(c: Context) -> DataFrame:
    """The stored fact is of the projects as they were. Projects updated
    before 1999 (or never): every tenth has since changed without a later
    last_update, so its stored row stays. Every second project updated in
    January 1999 was stored as of the first of that month: the batch, everything
    updated after the stored maximum, replaces its row."""
    p, at = c.st.project, F.col("last_update")
    early = F.coalesce(at < ntz(PROJECT_SPLIT_TS), F.lit(True))
    january = ~early & (at < ntz(PROJECT_SPLIT_END)) & (F.col("project_id") % 2 == 0)
    was = {"percent_complete": F.when(early & (F.col("project_id") % 10 == 0), F.lit(50).cast("decimal(5,2)"))
           .otherwise(F.col("percent_complete")),
           "last_update": F.when(early, at).otherwise(ntz(PROJECT_SPLIT_TS))}
    # one reading gives both kinds of stored projects
    before = p.filter(early | january).select(*[was.get(x, F.col(x)).alias(x) for x in p.columns])
    return _merged(c, facts.project_fact, c.st.replace(project=before), c.st, "row_key",
                   cutoff="last_update")


# ------------------------------------------------------------------ storage
def sink_version(c: Context) -> DataFrame:
    """K2: a dimension written as a version twice and read back."""
    root = _folder(c, "versions")
    write_version(c.marts.business_unit.limit(0), root)
    write_version(c.marts.business_unit, root)
    return read_current(c.spark, root)


def sink_snapshot_parts(c: Context) -> DataFrame:
    """K4: the client history stored in two parts by two runs."""
    root, spec = _folder(c, "history"), SNAPSHOTS["client"]
    snapshot_parts(c.st.client.filter(F.col("client_id") % 13 != 0), spec, CLIENT_RUN1_TS, root)
    snapshot_parts(client_second_state(c.st), spec, CLIENT_RUN2_TS, root)
    return read_history(c.spark, root)


def kept_reductions(c: Context) -> DataFrame:
    """The monthly sums that the build keeps, after two runs. The first knows the
    events before the split month but for every seventh record; the second adds
    those, as late events numbered above all that the first knew, and the months
    from the split on."""
    parts = []
    for name, r in REDUCTIONS.items():
        events, root = getattr(c.st, name), _folder(c, "reduced")
        # numbers in the order of arrival: what the first run knows, new months, late events
        late = F.col(r.number) % 7 == 0
        new = F.col(r.date) >= F.lit(MERGE_SPLIT_MONTH)
        shift = F.when(late & ~new, F.lit(2)).when(new, F.lit(1)).otherwise(F.lit(0)) * F.lit(1 << 40)
        numbered = events.withColumn(r.number, F.col(r.number) + shift)
        maintain(c.spark, numbered.filter(~new & ~late), r, root)
        kept = maintain(c.spark, numbered, r, root).frame()
        parts.append(kept.select(F.lit(name).alias("events"), *[F.col(k).cast("long").alias(f"key_{i}") for i, k in
                                                                enumerate(r.keys)],
                                 F.col(r.date).alias("month"), F.col(r.value).cast("decimal(38,4)").alias("total")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def source_registry(c: Context) -> DataFrame:
    """The 14 sources written under one root and read back by the registry."""
    root = _folder(c, "sources")
    for name, df in sources_from_driver(c.spark, c.sf_dir).items():
        df.write.parquet(f"{root}/{name}")
    return reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
        for name, df in read_sources(c.spark, root).items()])


def date_dims(c: Context) -> DataFrame:
    """The date dimensions of the four marts over the calendar."""
    from practica.operators.calendar import date_dim
    sem = c.sem
    return reduce(lambda a, b: a.unionByName(b), [
        date_dim(c.spark, sem.calendar_start, sem.calendar_end).withColumn("mart", F.lit(mart))
        for mart in ("business_development", "financial_report", "hr", "project_management")])


# ------------------------------------------------------------------ checks
def _pm_checks(c: Context) -> tuple[DataFrame, DataFrame]:
    return c.fact(facts.project_fact), c.marts.project


def check_not_null(c: Context) -> DataFrame:
    pf, pdim = _pm_checks(c)
    bu, cl = c.marts.business_unit, c.marts.client
    checks = [q.not_null("project_fact", pf, col) for col in
              ("row_key", "project_id", "project_key", "date", "percent_complete",
               "potential_problem_project")]
    checks += [q.not_null("project_dim", pdim, col) for col in ("project_key", "project_id")]
    checks += [q.not_null("businessunit_dim", bu, col) for col in ("unitkey", "unitid", "name")]
    checks += [q.not_null("client_dim", cl, col) for col in ("client_key", "client_id", "client_name")]
    return q.summarize(checks)


def check_unique(c: Context) -> DataFrame:
    pf, pdim = _pm_checks(c)
    return q.summarize([q.unique("project_fact", pf, "row_key"),
                        q.unique("project_dim", pdim, "project_key"),
                        q.unique("businessunit_dim", c.marts.business_unit, "unitkey"),
                        q.unique("client_dim", c.marts.client, "client_key"),
                        q.unique("deliverable_dim", c.marts.deliverable, "deliverable_key")])


def check_accepted(c: Context) -> DataFrame:
    pf, pdim = _pm_checks(c)
    return q.summarize([q.accepted_values("project_dim", pdim, "type", ["Fixed", "Time and Material"]),
                        q.accepted_values("project_fact", pf, "if_late_start_flag", [0, 1]),
                        q.accepted_values("project_fact", pf, "potential_problem_project", [0, 1])])


def check_relationships(c: Context) -> DataFrame:
    pf, pdim = _pm_checks(c)
    return q.summarize([
        q.relationships("project_fact", pf, "project_key", pdim, "project_key"),
        q.relationships("project_fact", pf, "client_key", c.marts.client, "client_key"),
        q.relationships("project_fact", pf, "business_unit_key", c.marts.business_unit, "unitkey"),
    ])


def check_range(c: Context) -> DataFrame:
    pf, _ = _pm_checks(c)
    checks = [q.between_0_and_100("project_fact", pf, "percent_complete")]
    checks += [q.non_negative("project_fact", pf, col) for col in
               ("planned_duration_days", "actual_duration_days", "hours_spent",
                "project_expenses_per_month", "consultant_hour_costs_per_month", "total_expenses",
                "forecasted_cost", "revenue_received_per_month")]
    return q.summarize(checks)


def check_dates(c: Context) -> DataFrame:
    pdim = c.marts.project
    return q.summarize([
        q.end_after_start_or_null("project_dim", pdim, "planned_end_date", "planned_start_date"),
        q.end_strictly_after_start("project_dim", pdim, "planned_end_date", "planned_start_date"),
        q.price_non_negative("project_dim", pdim),
    ])


def check_patterns(c: Context) -> DataFrame:
    cl, co = c.marts.client, c.marts.consultant
    return q.summarize([q.phone_pattern("client_dim", cl, "phone_number"),
                        q.email_pattern("client_dim", cl, "email"),
                        q.phone_pattern("consultant_dim", co, "contact")])


def catalog_relations(c: Context) -> dict[str, DataFrame]:
    """Every relation the declared data tests name, built from the driver tables."""
    from practica.operators.calendar import date_dim
    cal = date_dim(c.spark, c.sem.calendar_start, c.sem.calendar_end)
    bu = c.marts.business_unit
    return {
        "bd_date_dim": cal, "hr_date_dim": cal, "project_date_dim": cal,
        "bd_business_unit_dim": bu.withColumnRenamed("unitkey", "business_unit_key"),
        "businessunit_dim": bu,
        "client_dim": c.marts.client,
        "consultant_dim": c.marts.consultant,
        "title_history_dim": c.marts.title_history,
        "deliverable_dim": c.marts.deliverable,
        "project_dim": c.marts.project,
        "business_dev_fact": c.fact(facts.business_dev_fact),
        "hr_utilization": c.fact(facts.hr_utilization),
        "hr_deliverable_bridge": c.fact(facts.hr_deliverable_bridge),
        "hr_client_bridge": c.fact(facts.hr_client_bridge),
        "project_fact": c.fact(facts.project_fact),
    }


def check_catalog(c: Context) -> DataFrame:
    """Q1-Q12: every declared data test of the four marts.

    The facts are written once to the shared folder (each feeds many
    checks), as the build checks stored facts. Deliverables are written before
    them: a fact that joins the dimension reads it from there."""
    from practica.plans.check_catalog import run_catalog
    c.marts = c.marts.replace(deliverable=materialize(c.marts.deliverable))
    rels = catalog_relations(c)
    for name in ("business_dev_fact", "hr_utilization", "hr_deliverable_bridge", "hr_client_bridge", "project_fact"):
        rels[name] = materialize(rels[name])
    return run_catalog(rels)


REGISTRY: dict[str, Callable[[Context], DataFrame]] = {
    "staging_project": staging_project,
    **{f"staging_{f}": _staged(f) for f in STAGED_FIELDS},
    "calendar": calendar,
    "surrogate_keys": surrogate_keys,
    "project_row_key": project_row_keys,
    "fixed_revenue_month": fixed_revenue_month,
    "expense_revenue_month": expense_revenue_month,
    "consultant_revenue_month": consultant_revenue_month,
    "satisfaction_month": satisfaction_month,
    "fixed_incomplete": fixed_incomplete,
    "tm_incomplete": tm_incomplete,
    "expense_unit_month": expense_unit_month,
    "direct_cost_unit_month": direct_cost_unit_month,
    "indirect_cost_unit_month": indirect_cost_unit_month,
    "revenue_per_project": revenue_per_project,
    "unit_revenue": unit_revenue,
    "consultant_hours": consultant_hours,
    "project_hours": project_hours,
    "project_expense_month": project_expense_month,
    "consultant_cost_month": consultant_cost_month,
    "latest_project": latest_project,
    "activity_spine": activity_spine,
    "scd2_client_two_runs": scd2_client_two_runs,
    "scd2_all_two_runs": scd2_all_two_runs,
    "staging_text_dates": staging_text_dates,
    "dim_project": dim_project,
    "dim_client": dim_client,
    "dim_business_unit": dim_business_unit,
    "dim_consultant": dim_consultant,
    "dim_deliverable": dim_deliverable,
    "dim_deliverable_two_versions": dim_deliverable_two_versions,
    "fact_project_all_versions": fact_project_all_versions,
    "dim_title_history": dim_title_history,
    "fact_project": fact_project,
    "fact_finance": fact_finance,
    "fact_finance_any_anchor": fact_finance_any_anchor,
    "fact_project_fraction": fact_project_fraction,
    "tm_incomplete_literal_status": tm_incomplete_literal_status,
    "fact_business_dev": fact_business_dev,
    "hr_utilization": hr_utilization,
    "hr_deliverable_bridge": hr_deliverable_bridge,
    "hr_client_bridge": hr_client_bridge,
    "merge_upsert_fact": merge_upsert_fact,
    "cutoff_last_update": cutoff_last_update,
    "merge_hr_utilization": merge_hr_utilization,
    "merge_schema_change": merge_schema_change,
    "merge_business_dev": merge_business_dev,
    "sink_version": sink_version,
    "sink_snapshot_parts": sink_snapshot_parts,
    "kept_reductions": kept_reductions,
    "source_registry": source_registry,
    "date_dims": date_dims,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_accepted": check_accepted,
    "check_relationships": check_relationships,
    "check_range": check_range,
    "check_dates": check_dates,
    "check_patterns": check_patterns,
    "check_catalog": check_catalog,
}


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(fn) for name, fn in REGISTRY.items()}
