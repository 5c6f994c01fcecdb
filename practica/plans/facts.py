"""The four fact builders.

Each builder returns one lazy plan. Measures are aggregated to their own
grain before any join (the joins see key-month rows, never raw entries), and
measures that share a grain are merged with one union + group-by instead of
a chain of joins, so each fact shuffles its aggregated inputs once per grain.

Calendar joins are range tests (``in_calendar``): the calendar holds each day
in [start, end] once, so the join adds nothing but membership.

Incremental runs: pass ``target`` (the stored fact). The builder applies the
fact's cutoff and returns only the rows to merge; ``merge_upsert`` does the
rest. A cutoff is one scalar, read from the manifest of a stored table.

``dealt`` moves the rows (of one ``month`` each) as they will be stored, before
their keys are made of them: ids and dates move, not 32 characters for each key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from practica.functions.keys import day_to_key, month_start, ntz, project_row_key, surrogate_key, ts_to_key
from practica.operators import measures as m
from practica.operators.dims import versions
from practica.operators.incremental import last_update_watermark, month_before, month_cutoff
from practica.operators.parts import Stored
from practica.operators.scd2 import VALID_FROM
from practica.plans.marts import Marts, calendar_date, in_calendar
from practica.semantics import TYPE_FIXED, TYPE_TM, Semantics
from practica.sources.tables import Staged

AMOUNT = "decimal(38,4)"


def _merge_measures(keys: list[str], parts: list[tuple[DataFrame, list[str]]],
                    how: dict[str, str] | None = None) -> DataFrame:
    """Outer-merge measures that share ``keys`` with one union + group-by.

    Where each part holds unique keys and a column of its own, ``sum`` over a key
    returns the part's value (NULL when absent or NULL), exactly what a chain of
    outer joins would give -- with one shuffle instead of one per join; parts may
    also hold summands. NULL keys form their own group, as in GROUP BY.
    """
    how = how or {}
    all_cols = list(dict.fromkeys(c for _, cols in parts for c in cols))
    types = {}
    for df, cols in parts:
        for c in cols:
            types[c] = df.schema[c].dataType
    branches = []
    for df, cols in parts:
        branches.append(df.select(*keys, *[
            (F.col(c) if c in cols else F.lit(None).cast(types[c])).alias(c) for c in all_cols]))
    u = reduce(lambda a, b: a.unionByName(b), branches)
    aggs = [getattr(F, how.get(c, "sum"))(c).alias(c) for c in all_cols]
    return u.groupBy(*keys).agg(*aggs)


def _cut(df: DataFrame, cutoff, month: str, sem: Semantics) -> DataFrame:
    """Rows from ``cutoff`` on. Without one (an empty stored fact) all rows, or
    none where ``sem.empty_target`` is "nothing"."""
    if cutoff is not None:
        return df.filter(F.col(month) >= F.lit(cutoff))
    return df.filter(F.lit(False)) if sem.empty_target == "nothing" else df


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


# ------------------------------------------------------------------ finance
def latest_expense_cutoff(st: Staged, sem: Semantics):
    """A month before the latest month with project expense in the calendar."""
    first, last = sem.month_bounds()
    day = F.when(F.col("expense_date").between(F.lit(first), F.lit(last)), F.col("expense_date"))
    return st.project_expense.agg(F.add_months(F.trunc(F.max(day), "month"), -1).alias("c")).first()["c"]


def finance_fact(st: Staged, marts: Marts, sem: Semantics = Semantics(),
                 target: DataFrame | Stored | None = None, latest_expense: dt.date | None = None,
                 dealt: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """M4-M6: monthly unit profit and loss.

    Rows are unit-months with project expense (``anchor='expense'``) whose
    month is in the calendar; ``anchor='any'`` keeps every unit-month with
    any measure. The OR-join to the calendar reduces to the expense month
    (every other branch equals it or is NULL under the USING joins).
    """
    keys = ["unit_id", "month"]
    bounds, cutoff = sem.month_bounds(), None
    if target is not None and sem.anchor == "expense":
        # I4: one-month lookback from this batch's latest month, which is the
        # latest month with expense in the calendar: one pruned column
        # (given by the build, which knows it from the reduction's manifest)
        cutoff = month_before(latest_expense) if latest_expense else latest_expense_cutoff(st, sem)
        bounds = sem.month_bounds(cutoff)
    if target is None:
        # each large input read once, giving the summands of every measure
        summands = _merge_measures([*keys, "project_id"], m.unit_month_parts(st, sem), how={"_anchor": "max"})
        summands = (summands.filter(F.col("month").between(*map(F.lit, bounds)))
                    .withColumn("total_revenue", F.round("total_revenue", 2)).drop("project_id"))
        parts = [(summands, [c for c in summands.columns if c not in keys])]
    else:
        # costs read from the cutoff on; revenue is dated by planned start but
        # sums a project's whole past
        revenue = m.unit_revenue_month(st, sem).filter(F.col("month").between(*map(F.lit, bounds)))
        parts = [(m.expense_unit_month(st, bounds).withColumn("_anchor", F.lit(1)), ["monthly_amount", "_anchor"]),
                 (m.direct_cost_unit_month(st, bounds), ["total_billable_consultant_cost"]),
                 (revenue, ["total_revenue"])]
    merged = _merge_measures(keys, [*parts, (
        m.indirect_cost_unit_month(st, bounds), ["total_non_proj_labor_costs", "total_other_expense_costs"])],
        how={"_anchor": "max"})
    if sem.anchor == "expense":
        # USING joins never match a NULL unit: the other measures are blank there
        blank = F.col("unit_id").isNull()
        merged = merged.filter(F.col("_anchor").isNotNull()).select(
            "unit_id", "month", "monthly_amount",
            *[F.when(~blank, F.col(c)).alias(c) for c in
              ("total_billable_consultant_cost", "total_non_proj_labor_costs",
               "total_other_expense_costs", "total_revenue")])
    rows = merged.filter(in_calendar(F.col("month"), sem))

    if target is not None:
        rows = _cut(rows, month_cutoff(rows, "month") if sem.anchor != "expense" else cutoff, "month", sem)

    bu = versions(marts.business_unit, sem).select("unitid", F.col("unitkey").alias("unit_key"))
    j = dealt(rows.join(bu, rows.unit_id == bu.unitid, "left"))

    pe, dc = F.col("monthly_amount"), F.col("total_billable_consultant_cost")
    lab, oth = F.col("total_non_proj_labor_costs"), F.col("total_other_expense_costs")
    total = pe + dc + lab + oth
    return j.select(
        surrogate_key(F.col("unit_id"), day_to_key("month")).alias("row_key"),
        F.col("unit_key"),
        pe.cast(AMOUNT).alias("direct_project_expenses"),
        dc.cast(AMOUNT).alias("direct_billable_consultant_cost"),
        (pe + dc).cast(AMOUNT).alias("total_direct_cost"),
        lab.cast(AMOUNT).alias("indirect_nonbillable_consultant_cost"),
        oth.cast(AMOUNT).alias("indirect_other_expense_cost"),
        (lab + oth).cast(AMOUNT).alias("total_indirect_costs"),
        total.cast(AMOUNT).alias("total_expenses"),
        F.col("total_revenue").cast(AMOUNT).alias("total_revenue"),
        (F.col("total_revenue") - total).cast(AMOUNT).alias("profit"),
        F.col("month").alias("date"),
    )


# ------------------------------------------------------- business development
def business_dev_fact(st: Staged, marts: Marts, sem: Semantics = Semantics(),
                      target: DataFrame | Stored | None = None,
                      dealt: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """M1-M3 at client-unit-month grain.

    The activity spine (U1) is the key set of one merged aggregate over the
    six measures. Revenue received = A1 + A2 + A3 and forecast = A5 + A6 are
    taken at the spine row's own unit (the source joins them by client and
    month only, repeating them across units and client projects).
    """
    keys = ["client_id", "unit_id", "month"]
    # One-month lookback from the stored fact; each measure reads from there
    cutoff = month_cutoff(target, "date") if target is not None else None
    bounds = sem.month_bounds(cutoff)
    # the summands of all measures meet in one grouping
    parts = [
        (m.fixed_price_month(st, sem, bounds, summands=True), {"revenue": "total_fp_revenue", "incomplete": "incomplete_fp_revenue"}),
        (m.expense_revenue_month(st, bounds, summands=True), {"revenue": "total_tm_expense_revenue"}),
        (m.consultant_revenue_month(st, bounds, summands=True), {"revenue": "total_tm_consultant_revenue"}),
        (m.satisfaction_month(st, bounds, summands=True), {"s": "s", "n": "n"}),
        (m.tm_incomplete_month(st, sem, bounds, summands=True), {"remaining": "remaining"}),
    ]
    types = {"revenue": AMOUNT, "incomplete": AMOUNT, "s": "bigint", "n": "bigint", "remaining": "decimal(38,6)"}
    rows = reduce(lambda a, b: a.unionByName(b), [
        df.select(*keys, *[(F.col(of[c]) if c in of else F.lit(None)).cast(t).alias(c) for c, t in types.items()])
        for df, of in parts])
    rows = rows.filter(F.col("client_id").isNotNull() & in_calendar(F.col("month"), sem))
    if target is not None:
        rows = _cut(rows, cutoff, "month", sem)
    g = rows.groupBy(*keys).agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(AMOUNT).alias("revenue_received"),
        m.average_satisfaction().alias("average_satisfaction"),
        (F.coalesce(F.sum("incomplete"), F.lit(0)) + F.coalesce(m.incomplete_tm_revenue(), F.lit(0))).cast(AMOUNT)
        .alias("forecasted_future_revenue"))

    # a version's key is its id and start: these move to the joins, not the 32 characters made of them
    c = versions(marts.client, sem).select(F.col("client_id").alias("c_client_id"), F.col(VALID_FROM).alias("c_from"))
    bu = versions(marts.business_unit, sem).select("unitid", F.col(VALID_FROM).alias("u_from"))
    j = dealt(g.join(c, g.client_id == c.c_client_id, "inner")
              .join(bu, F.col("unit_id") == bu.unitid, "left"))
    return j.select(
        surrogate_key(F.col("client_id"), F.col("unit_id"), day_to_key("month"))
        .alias("client_feedback_key"),
        surrogate_key(F.col("c_client_id"), ts_to_key(F.col("c_from"))).alias("client_key"),
        F.when(F.col("unitid").isNotNull(), surrogate_key(F.col("unitid"), ts_to_key(F.col("u_from")))).alias("business_unit_key"),
        F.col("month").alias("date"), "revenue_received", "average_satisfaction", "forecasted_future_revenue")


# ---------------------------------------------------------------------- HR
def title_as_of_month(hours: DataFrame, title_history: DataFrame) -> DataFrame:
    """Open title-history row in force for each (consultant, month): the one
    with the latest start date on or before the month's end.

    As-of join without pairs: month rows and title rows are unioned per
    consultant and ordered by (month, titles first, start date, id); a running
    ``last(..., ignorenulls)`` carries the latest title forward.
    """
    t = (title_history.filter(F.col("valid_to").isNull() & F.col("startdate").isNotNull())
         .select("consultant_id", month_start("startdate").alias("at"), F.lit(0).alias("kind"),
                 F.col("startdate").alias("start"), F.col("id").alias("tid"),
                 F.col("titlehistory_key").alias("key")))
    h = hours.select("consultant_id", F.col("month").alias("at"), F.lit(1).alias("kind"),
                     F.lit(None).cast("date").alias("start"), F.lit(None).cast("long").alias("tid"),
                     F.lit(None).cast("string").alias("key"))
    w = (Window.partitionBy("consultant_id").orderBy("at", "kind", "start", "tid")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (t.unionByName(h).withColumn("titlehistory_key", F.last("key", ignorenulls=True).over(w))
            .filter(F.col("kind") == 1)
            .select("consultant_id", F.col("at").alias("month"), "titlehistory_key"))


def hr_utilization(st: Staged, marts: Marts, sem: Semantics = Semantics(),
                   target: DataFrame | Stored | None = None,
                   dealt: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """M7/M8 at its real grain, consultant-month (where the declared key is unique).

    The source fact also multiplies each row by every deliverable of the
    consultant and every client of the unit's projects; those many-to-many
    links are the two bridges below, joined on demand.
    """
    h = m.consultant_hours_month(st)
    if target is not None:  # I3 on the fact's date: months outside the calendar (NULL date) drop
        cutoff = month_cutoff(target, "date")
        h = _cut(h, cutoff, "month", sem).filter(in_calendar(F.col("month"), sem))
    cd = versions(marts.consultant, sem).select(F.col("consultant_id").alias("cd_id"), "consultant_key")
    unit = st.consultant.select(F.col("consultant_id").alias("u_id"), F.col("business_unit_id"))
    bu = versions(marts.business_unit, sem).select("unitid", F.col("unitkey").alias("business_unit_key"))
    th = title_as_of_month(h.select("consultant_id", "month"),
                           versions(marts.title_history, sem)).withColumnRenamed("consultant_id", "t_id") \
        .withColumnRenamed("month", "t_month")
    j = (h.join(cd, h.consultant_id == cd.cd_id, "left")
         .join(unit, F.col("consultant_id") == F.col("u_id"), "left")
         .join(bu, F.col("business_unit_id") == F.col("unitid"), "left")
         .join(th, (F.col("consultant_id") == F.col("t_id")) & (F.col("month") == F.col("t_month")),
               "left"))
    j = dealt(j)
    return j.select(
        surrogate_key(F.col("consultant_id"), day_to_key("month")).alias("HR_record_key"),
        "consultant_id", F.col("month").alias("snapshot_month"), "consultant_key",
        "business_unit_id", "business_unit_key",
        calendar_date(F.col("month"), sem).alias("date"), "titlehistory_key",
        "billable_hours", "non_billable_hours", "total_hours", "billable_hours_percentage")


def hr_deliverable_bridge(st: Staged, marts: Marts, sem: Semantics = Semantics()) -> DataFrame:
    """M9, consultant -> deliverables worked (all time), for consultants with
    hours. A consultant with no time entry keeps one row with NULL deliverable."""
    # who ⟕ worked from one reading of each: both give (consultant, deliverable)
    # rows, reduced to distinct ones before anything joins. The two uses of the
    # pairs share their exchange, and the join back has the pairs, possibly skewed,
    # on the side that adaptive execution may split.
    one, none = F.lit(1), F.lit(0)
    pairs = (st.time_entry.select("consultant_id", "deliverable_id", one.alias("worked"), none.alias("listed"))
             .unionByName(st.non_billable_hours.select("consultant_id", F.lit(None).cast("long").alias("deliverable_id"),
                                                       none.alias("worked"), one.alias("listed")))
             .groupBy("consultant_id", "deliverable_id").agg(F.max("worked").alias("worked"), F.max("listed").alias("listed")))
    who = (pairs.groupBy(F.col("consultant_id").alias("w_id")).agg(F.max("listed").alias("_listed"), F.max("worked").alias("_worked"))
           .filter("_listed = 1"))
    known = F.col("consultant_id").isNotNull()
    links = (pairs.join(who, F.col("consultant_id").eqNullSafe(F.col("w_id")))
             .filter(((F.col("worked") == 1) & known) | ((F.col("listed") == 1) & ((F.col("_worked") == 0) | ~known)))
             .select("consultant_id", F.when(known, F.col("deliverable_id")).alias("deliverable_id")))
    # a version's id and start move to the join, not its key (see project_fact)
    dd = versions(marts.deliverable, sem).select(F.col("deliverable_id").alias("d_id"), F.col(VALID_FROM).alias("d_from"))
    key = F.when(F.col("d_id").isNotNull(), surrogate_key(F.col("d_id"), ts_to_key(F.col("d_from"))))
    return (links.join(dd, F.col("deliverable_id") == F.col("d_id"), "left")
            .select("consultant_id", "deliverable_id", key.alias("deliverable_key")))


def hr_client_bridge(st: Staged, marts: Marts, sem: Semantics = Semantics()) -> DataFrame:
    """M9, business unit -> clients of the unit's projects (joined to
    utilization through its business_unit_id)."""
    pairs = (st.project.filter(F.col("unit_id").isNotNull())
             .select("unit_id", "client_id").distinct())
    c = versions(marts.client, sem).select(F.col("client_id").alias("c_id"), "client_key")
    return (pairs.join(c, F.col("client_id") == F.col("c_id"), "left")
            .select(F.col("unit_id").alias("business_unit_id"), "client_id", "client_key"))


# ----------------------------------------------------------------- project
def project_fact(st: Staged, marts: Marts, sem: Semantics = Semantics(),
                 target: DataFrame | Stored | None = None,
                 dealt: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """One row per project at the month of its latest update.

    Incremental (I5): only projects updated after the stored fact's latest
    ``last_update`` (kept as a column for exactly this purpose).
    """
    src, since = st.project, None
    if target is not None:
        since = last_update_watermark(target)
        src = src.filter(F.col("last_update") > ntz(since))
    # a version's key is its id and start: these move to the join, not the 32 characters made of them; a client's
    # starts meet its projects before all that is known of them does, and stay one list until then
    starts = (versions(marts.client, sem).groupBy(F.col("client_id").alias("cd_id"))
              .agg(F.collect_list(VALID_FROM).alias("_client_starts")))
    src = src.join(starts, F.col("client_id") == F.col("cd_id"), "left").drop("cd_id")
    l = m.latest_project(src, sem).withColumn("month", month_start("last_update"))

    l = m.with_history(l, st, sem, since)

    pd_ = versions(marts.project, sem).select(F.col("project_id").alias("pd_id"), F.col(VALID_FROM).alias("pd_from"))
    bu = versions(marts.business_unit, sem).select("unitid", F.col(VALID_FROM).alias("u_from"))

    def version_key(held: str, start: str) -> Column:
        return F.when(F.col(held).isNotNull(), surrogate_key(F.col(held), ts_to_key(F.col(start))))

    j = (l.join(pd_, l.project_id == pd_.pd_id, "left")
         .join(bu, F.col("unit_id") == F.col("unitid"), "left")
         .select("*", F.explode_outer("_client_starts").alias("cd_from")))

    pct = F.col("percent_complete")
    div = sem.percent_divisor(pct)
    a_start, a_end = F.col("actual_start_date"), F.col("actual_end_date")
    p_start, p_end = F.col("planned_start_date"), F.col("planned_end_date")
    ptype = F.col("project_type")
    late = F.when(a_start.isNotNull() & p_start.isNotNull() & (a_start > p_start), 1).otherwise(0)
    elapsed = F.datediff(F.lit(sem.as_of), a_start)
    expected_end = F.when(
        a_start.isNotNull() & pct.isNotNull() & (pct > 0),
        F.date_add(a_start, F.round(elapsed / F.nullif(div, F.lit(0))).cast("int")))
    total_exp = F.col("project_expenses_per_month") + F.col("consultant_hour_costs_per_month")
    forecast = F.when(pct.isNotNull() & (pct > 0),
                      total_exp.cast("double") / F.nullif(div, F.lit(0)).cast("double"))
    problem = (
        (p_end.isNotNull() & F.col("expected_end_date").isNotNull()
         & (p_end < F.col("expected_end_date")))
        | ((ptype == TYPE_FIXED) & F.col("forecasted_cost").isNotNull() & F.col("price").isNotNull()
           & (F.col("forecasted_cost") > F.col("price").cast("double")))
        | ((ptype == TYPE_TM) & F.col("forecasted_cost").isNotNull()
           & F.col("estimated_budget").isNotNull()
           & (F.col("forecasted_cost") > F.col("estimated_budget")))
    )
    base = j.select(
        "*",
        late.alias("if_late_start_flag"),
        F.datediff(p_end, p_start).alias("planned_duration_days"),
        F.when(a_start.isNotNull() & a_end.isNotNull(), F.datediff(a_end, a_start))
        .alias("actual_duration_days"),
        expected_end.alias("expected_end_date"),
        total_exp.cast(AMOUNT).alias("total_expenses"),
        forecast.alias("forecasted_cost"),
        m.revenue_by_type().alias("revenue_received_per_month"),
    )
    rows = dealt(base.withColumn("potential_problem_project", F.when(problem, 1).otherwise(0)))
    return rows.select(
        project_row_key(F.col("project_id"), F.col("month")).alias("row_key"),
        "project_id", version_key("pd_id", "pd_from").alias("project_key"),
        F.when(F.col("cd_from").isNotNull(), version_key("client_id", "cd_from")).alias("client_key"),
        version_key("unitid", "u_from").alias("business_unit_key"),
        F.col("month").alias("date"),
        calendar_date(a_start, sem).alias("actual_start_date_key"),
        calendar_date(a_end, sem).alias("actual_end_date_key"),
        "percent_complete", "status", "if_late_start_flag", "planned_duration_days",
        "actual_duration_days", "expected_end_date",
        F.col("hours_spent").cast(AMOUNT).alias("hours_spent"),
        F.col("project_expenses_per_month").cast(AMOUNT).alias("project_expenses_per_month"),
        F.col("consultant_hour_costs_per_month").cast(AMOUNT).alias("consultant_hour_costs_per_month"),
        "total_expenses", "forecasted_cost", "revenue_received_per_month",
        "potential_problem_project", "last_update",
    )
