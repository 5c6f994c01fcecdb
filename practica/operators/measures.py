"""Monthly and per-project measures (grouped sums and averages).

Scale notes
-----------
The source models join raw time entries to every billing rate of the
project and to every payroll record of the consultant, then sum
``hours * rate``. Written that way the join fans out before it aggregates,
and a hot project or consultant lands in one task. Here the same sums are
taken *before* the fan-out join, using

    sum over pairs (h * r) = (sum h) * (sum r)      per join key,

which holds exactly for decimals and keeps the SQL NULL rules (a product
with a NULL factor is skipped; an all-NULL group stays NULL). Raw rows are
first reduced to (key, month) with map-side partial aggregation, so a key
holding a third of all rows is collapsed inside each map task before any
shuffle, and the joins see one row per key-month.

Output columns: ``client_id``, ``unit_id``, ``project_id``, ``consultant_id``
and ``month`` (first day of month, DATE) as grouping keys, plus the measure.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from practica.functions.keys import month_start, ntz
from practica.semantics import TYPE_FIXED, TYPE_TM, Semantics
from practica.sources.tables import Staged

Bounds = tuple[dt.date, dt.date]

AMOUNT = "decimal(38,4)"
MONEY_OUT = "decimal(38,2)"


def _sum(col: str, alias: str) -> F.Column:
    return F.sum(col).alias(alias)


def _projects(st: Staged, *cols: str) -> DataFrame:
    return st.project.select("project_id", *cols)


def _within(df: DataFrame, date_col, bounds: Bounds | None) -> DataFrame:
    """Rows whose date is in ``bounds`` (first and last day of whole months):
    a test on the raw date, so it reaches the scan."""
    if bounds is None:
        return df
    date = F.col(date_col) if isinstance(date_col, str) else date_col
    return df.filter(date.between(*map(F.lit, bounds)))


# ---------------------------------------------------------------- reductions
def hours_by_deliverable_month(st: Staged, *extra: str, bounds: Bounds | None = None) -> DataFrame:
    return (_within(st.time_entry, "work_date", bounds).groupBy("deliverable_id", *extra, month_start("work_date").alias("month"))
            .agg(_sum("hours", "hours")))


def hours_by_project_month(st: Staged, *extra: str, only: DataFrame | None = None,
                           bounds: Bounds | None = None) -> DataFrame:
    """Time entries -> (deliverable's project, month); NULL project when the
    deliverable is unknown (left join, as the source).

    ``only`` (project_id, month) restricts the result to those keys: the
    deliverables are narrowed to the keyed projects first and the entries
    join them on (deliverable, month), so entries of other months never
    reach the aggregation.
    """
    d = st.deliverable.select("deliverable_id", "project_id")
    if only is None:
        # few entries share a deliverable and month: they are reduced where they meet their project
        te = _within(st.time_entry, "work_date", bounds).select("deliverable_id", *extra, month_start("work_date").alias("month"),
                                                                "hours")
        j = te.join(d, "deliverable_id", "left")
    else:
        te = hours_by_deliverable_month(st, *extra, bounds=bounds)
        j = te.join(d.join(only, "project_id", "inner"), ["deliverable_id", "month"], "inner")
    return j.groupBy("project_id", *extra, "month").agg(_sum("hours", "hours"))


def rate_by_project(st: Staged) -> DataFrame:
    return (st.billing_rate.filter(F.col("project_id").isNotNull())
            .groupBy("project_id").agg(_sum("rate", "rate_sum")))


def payroll_by_consultant(st: Staged) -> DataFrame:
    return (st.payroll.filter(F.col("consultant_id").isNotNull())
            .groupBy("consultant_id").agg(_sum("amount", "amount_sum")))


def _deliverable_price_by_project_month(st: Staged, bounds: Bounds | None = None) -> DataFrame:
    return (_within(st.deliverable, "due_date", bounds).groupBy("project_id", month_start("due_date").alias("month"))
            .agg(_sum("price", "price")))


# ---------------------------------------------------- client/unit/month (BD)
def _fixed_price_deliverables(st: Staged, bounds: Bounds | None = None) -> DataFrame:
    """Deliverable prices by (project, month) joined to fixed-price projects,
    status kept."""
    p = (st.project.filter(F.col("project_type") == TYPE_FIXED)
         .select("project_id", "client_id", "unit_id", "status"))
    return _deliverable_price_by_project_month(st, bounds).join(p, "project_id", "inner")


def _by_client_month(rows: DataFrame, summands: bool, *aggs: F.Column) -> DataFrame:
    """``rows`` reduced to (client, unit, month), or with ``summands`` as they are:
    the caller adds up several measures in one grouping."""
    return rows if summands else rows.groupBy("client_id", "unit_id", "month").agg(*aggs)


def fixed_price_month(st: Staged, sem: Semantics = Semantics(), bounds: Bounds | None = None,
                      summands: bool = False) -> DataFrame:
    """A1 and A5 side by side: one join, one group-by, two conditional sums."""
    done, open_ = sem.completed(F.col("status")), sem.not_completed(F.col("status"))
    rows = (_fixed_price_deliverables(st, bounds).filter(done | open_)
            .select("client_id", "unit_id", "month", F.when(done, F.col("price")).alias("total_fp_revenue"),
                    F.when(open_, F.col("price")).alias("incomplete_fp_revenue")))
    return _by_client_month(rows, summands, *[_sum(c, c) for c in ("total_fp_revenue", "incomplete_fp_revenue")])


def fixed_revenue_month(st: Staged, sem: Semantics = Semantics()) -> DataFrame:
    """A1: price of deliverables of completed fixed-price projects, by due month."""
    return (_fixed_price_deliverables(st).filter(sem.completed(F.col("status")))
            .groupBy("client_id", "unit_id", "month").agg(_sum("price", "total_fp_revenue")))


def fixed_incomplete_month(st: Staged, sem: Semantics = Semantics()) -> DataFrame:
    """A5: price of deliverables of fixed-price projects not completed."""
    return (_fixed_price_deliverables(st).filter(sem.not_completed(F.col("status")))
            .groupBy("client_id", "unit_id", "month").agg(_sum("price", "incomplete_fp_revenue")))


def expense_revenue_month(st: Staged, bounds: Bounds | None = None, summands: bool = False) -> DataFrame:
    """A2: billable project expense by client, unit, expense month.

    Expenses meet their project unreduced (few share a project and month), so they
    move by project once; a hot project is split by adaptive execution."""
    rows = (_within(st.project_expense, "expense_date", bounds).filter(F.col("is_billable") == 1)
            .select("project_id", month_start("expense_date").alias("month"), F.col("amount").alias("total_tm_expense_revenue"))
            .join(_projects(st, "client_id", "unit_id"), "project_id", "left").drop("project_id"))
    return _by_client_month(rows, summands, _sum("total_tm_expense_revenue", "total_tm_expense_revenue"))


def consultant_revenue_month(st: Staged, bounds: Bounds | None = None, summands: bool = False) -> DataFrame:
    """A3: hours x billing rate by client, unit, work month.

    The project is taken through the *rate's* project id (the source joins
    ``USING(project_id)`` after the rate), so hours without a rate fall into
    the NULL client/unit group with a NULL value. Deliverables carry rate, client
    and unit to their entries, which so are priced where they meet them and never
    move by project.
    """
    r = rate_by_project(st).withColumnRenamed("project_id", "rate_project_id")
    p = _projects(st, "client_id", "unit_id").withColumnRenamed("project_id", "p_project_id")
    d = (st.deliverable.select("deliverable_id", "project_id")
         .join(r, F.col("project_id") == F.col("rate_project_id"), "left")
         .join(p, F.col("rate_project_id") == F.col("p_project_id"), "left")
         .select("deliverable_id", "client_id", "unit_id", "rate_sum"))
    rows = (_within(st.time_entry, "work_date", bounds).select("deliverable_id", month_start("work_date").alias("month"), "hours")
            .join(d, "deliverable_id", "left")
            .select("client_id", "unit_id", "month", (F.col("hours") * F.col("rate_sum")).alias("total_tm_consultant_revenue")))
    return _by_client_month(rows, summands, _sum("total_tm_consultant_revenue", "total_tm_consultant_revenue"))


def average_satisfaction() -> F.Column:
    """sum of sums / sum of counts (NULL scores are skipped by both), in a grouping."""
    return F.sum("s").cast("double") / F.nullif(F.sum("n"), F.lit(0))


def satisfaction_month(st: Staged, bounds: Bounds | None = None, summands: bool = False) -> DataFrame:
    """A4: average feedback score by feedback client, project unit, start month
    (summands: sums ``s`` and counts ``n``)."""
    p = _within(st.project, F.coalesce("actual_start_date", "planned_start_date"), bounds).select("project_id", "unit_id",
                          month_start(F.coalesce("actual_start_date", "planned_start_date")).alias("month"))
    # feedback reduced to (project, client) sums and counts before the join
    cf = (st.client_feedback.groupBy("project_id", "client_id")
          .agg(F.sum("overall_satisfaction").alias("s"), F.count("overall_satisfaction").alias("n")))
    rows = p.join(cf, "project_id", "inner").select("client_id", "unit_id", "month", "s", "n")
    return _by_client_month(rows, summands, average_satisfaction().alias("average_satisfaction"))


def incomplete_tm_revenue() -> F.Column:
    """The remaining value in cents, in a grouping."""
    return F.round(F.sum("remaining"), 2).cast(MONEY_OUT)


def tm_incomplete_month(st: Staged, sem: Semantics = Semantics(), bounds: Bounds | None = None,
                        summands: bool = False) -> DataFrame:
    """Remaining value of open time-and-material projects.

    round(sum(coalesce(price, 0) * (1 - pct/100)), 2), written with a
    decimal 0.01 factor so it stays exact (summands: ``remaining``, not rounded).
    """
    p = _within(st.project, F.coalesce("actual_start_date", "planned_start_date"), bounds)
    p = p.filter(sem.not_completed(F.col("status")) & (F.col("project_type") == TYPE_TM))
    remaining = (F.coalesce(F.col("price"), F.lit(0)) * (F.lit(100) - F.col("percent_complete"))
                 * F.lit(Decimal("0.01")))
    rows = p.select("client_id", "unit_id", month_start(F.coalesce("actual_start_date", "planned_start_date")).alias("month"),
                    remaining.alias("remaining"))
    return _by_client_month(rows, summands, incomplete_tm_revenue().alias("incomplete_tm_revenue"))


def activity_spine(st: Staged, sem: Semantics = Semantics()) -> DataFrame:
    """Distinct (client, unit, month) with any BD measure, client not NULL.

    Catalyst merges the unions and the distinct into one two-phase aggregate.
    """
    keys = ["client_id", "unit_id", "month"]
    parts = [fixed_price_month(st, sem), expense_revenue_month(st), consultant_revenue_month(st),
             satisfaction_month(st), tm_incomplete_month(st, sem)]
    spine = parts[0].select(*keys)
    for part in parts[1:]:
        spine = spine.unionByName(part.select(*keys))
    return spine.filter(F.col("client_id").isNotNull()).distinct()


# ---------------------------------------------------------- unit/month (FIN)
def expense_unit_month(st: Staged, bounds: Bounds | None = None) -> DataFrame:
    """Project expense by the project's unit and expense month."""
    pe = (_within(st.project_expense, "expense_date", bounds).groupBy("project_id", month_start("expense_date").alias("month"))
          .agg(_sum("amount", "amount")))
    return (pe.join(_projects(st, "unit_id"), "project_id", "left")
            .groupBy("unit_id", "month").agg(_sum("amount", "monthly_amount")))


def direct_cost_unit_month(st: Staged, bounds: Bounds | None = None) -> DataFrame:
    """Hours x payroll amount by the consultant's unit and work month.

    Payroll joins by consultant only (every record of the consultant)."""
    te = (_within(st.time_entry, "work_date", bounds).groupBy("consultant_id", month_start("work_date").alias("month"))
          .agg(_sum("hours", "hours")))
    c = st.consultant.select("consultant_id", F.col("business_unit_id").alias("unit_id"))
    return (te.join(payroll_by_consultant(st), "consultant_id", "left")
            .join(c, "consultant_id", "left")
            .groupBy("unit_id", "month")
            .agg(F.sum(F.col("hours") * F.col("amount_sum")).alias("total_billable_consultant_cost")))


def indirect_cost_unit_month(st: Staged, bounds: Bounds | None = None) -> DataFrame:
    """Indirect costs by unit and month (yearmonth yyyyMM -> first day)."""
    month = F.to_date(F.col("yearmonth").cast("string"), "yyyyMM")
    costs = st.indirect_cost
    if bounds:
        costs = costs.filter(F.col("yearmonth").between(*[d.year * 100 + d.month for d in bounds]))
    return (costs.groupBy(F.col("business_unit_id").alias("unit_id"), month.alias("month"))
            .agg(F.sum("non_proj_labor_costs").cast(MONEY_OUT).alias("total_non_proj_labor_costs"),
                 F.sum("other_expense_costs").cast(AMOUNT).alias("total_other_expense_costs")))


# ------------------------------------------------------------- per project
def fixed_revenue_by_project(st: Staged, sem: Semantics = Semantics()) -> DataFrame:
    """A10: deliverable price of completed fixed-price projects."""
    p = (st.project.filter((F.col("project_type") == TYPE_FIXED) & sem.completed(F.col("status")))
         .select("project_id"))
    d = st.deliverable.groupBy("project_id").agg(_sum("price", "price"))
    return d.join(p, "project_id", "inner").groupBy("project_id").agg(_sum("price", "total_fp_revenue"))


def expense_revenue_by_project(st: Staged) -> DataFrame:
    """Billable expense per project."""
    return (st.project_expense.filter(F.col("is_billable") == 1).groupBy("project_id")
            .agg(_sum("amount", "total_tm_expense_revenue")))


def consultant_revenue_by_project(st: Staged) -> DataFrame:
    """Hours x every rate of the deliverable's project."""
    d = st.deliverable.select("deliverable_id", "project_id")
    hp = (st.time_entry.groupBy("deliverable_id").agg(_sum("hours", "hours"))
          .join(d, "deliverable_id", "left").groupBy("project_id").agg(_sum("hours", "hours")))
    return (hp.join(rate_by_project(st), "project_id", "left").groupBy("project_id")
            .agg(F.sum(F.col("hours") * F.col("rate_sum")).alias("total_tm_consultant_revenue")))


def revenue_by_type(type_col: str = "project_type") -> F.Column:
    """CASE type: fixed -> A10, time and material -> A11 + A12, else 0."""
    t = F.col(type_col)
    return (F.when(t == TYPE_FIXED, F.coalesce(F.col("total_fp_revenue"), F.lit(0)))
            .when(t == TYPE_TM, F.coalesce(F.col("total_tm_expense_revenue"), F.lit(0))
                  + F.coalesce(F.col("total_tm_consultant_revenue"), F.lit(0)))
            .otherwise(F.lit(0))).cast(AMOUNT)


def revenue_per_project(st: Staged, sem: Semantics = Semantics()) -> DataFrame:
    """M5: project revenue by type, dated by planned start month (any status
    for time and material)."""
    fp = fixed_revenue_by_project(st, sem)
    exp = expense_revenue_by_project(st)
    con = consultant_revenue_by_project(st)
    p = st.project.select("project_id", "unit_id", "project_type",
                          month_start("planned_start_date").alias("month"))
    j = p.join(fp, "project_id", "left").join(exp, "project_id", "left").join(con, "project_id", "left")
    return j.select("project_id", "unit_id", "month",
                    revenue_by_type().alias("total_project_revenue"))


def unit_revenue_month(st: Staged, sem: Semantics = Semantics()) -> DataFrame:
    """Project revenue summed by unit and planned-start month."""
    return (revenue_per_project(st, sem).groupBy("unit_id", "month")
            .agg(_sum("total_project_revenue", "total_revenue")))


def unit_month_parts(st: Staged, sem: Semantics = Semantics()) -> list[tuple[DataFrame, list[str]]]:
    """A7, A8 and A13 as summands by (unit_id, month, project_id), each large
    input read once; costs have no project_id.

    An expense counts in its month (A7) and, if billable on a time-and-material
    project, in the revenue of the project's planned month (A11). An entry counts
    twice in one reduction: by consultant and month for its cost (A8), by
    deliverable for what it earns (A12); both are priced by one join on (kind, id).
    A project's revenue is the sum of its summands (A10 to A12, and 0 for each
    project) in cents.
    """
    p = st.project.select("project_id", F.col("unit_id").alias("p_unit"), "project_type", "status",
                          month_start("planned_start_date").alias("p_month"))
    by_type = F.col("project_type") == TYPE_TM

    def summands(df: DataFrame, *rows: tuple) -> DataFrame:
        """One row for each (condition or None, unit, month, project, values)."""
        made = [F.struct(unit.alias("unit_id"), at.alias("month"), project.cast("long").alias("project_id"),
                         *[v.alias(n) for n, v in values.items()]) for _, unit, at, project, values in rows]
        kept = [s if when is None else F.when(when, s) for (when, *_), s in zip(rows, made)]
        return df.select(F.inline(F.filter(F.array(*kept), lambda x: x.isNotNull())))

    none = F.lit(None).cast(AMOUNT)
    spent = (st.project_expense.groupBy("project_id", "is_billable", month_start("expense_date").alias("month"))
             .agg(_sum("amount", "amount")).join(p, "project_id", "left"))
    amount = F.col("amount").cast(AMOUNT)
    expenses = summands(spent,
                        (None, F.col("p_unit"), F.col("month"), F.lit(None),
                         {"monthly_amount": amount, "_anchor": F.lit(1), "total_revenue": none}),
                        (by_type & (F.col("is_billable") == 1), F.col("p_unit"), F.col("p_month"), F.col("project_id"),
                         {"monthly_amount": none, "_anchor": F.lit(None).cast("int"), "total_revenue": amount}))

    by_consultant, by_deliverable = F.lit(0), F.lit(1)
    worked = (st.time_entry.select("hours", F.inline(F.array(
        F.struct(by_consultant.alias("kind"), F.col("consultant_id").cast("long").alias("id"), month_start("work_date").alias("month")),
        F.struct(by_deliverable.alias("kind"), F.col("deliverable_id").cast("long").alias("id"), F.lit(None).cast("date").alias("month")))))
        .groupBy("kind", "id", "month").agg(_sum("hours", "hours")))
    # every consultant of either relation, with unit and payroll sum side by side
    paid = (st.consultant.select(F.col("consultant_id").cast("long").alias("x_id"), F.col("business_unit_id").alias("x_unit"),
                                 F.lit(None).cast("decimal(38,2)").alias("price"))
            .unionByName(payroll_by_consultant(st).select(F.col("consultant_id").cast("long").alias("x_id"),
                                                          F.lit(None).cast("long").alias("x_unit"),
                                                          F.col("amount_sum").cast("decimal(38,2)").alias("price")))
            .groupBy("x_id").agg(F.max("x_unit").alias("x_unit"), F.max("price").alias("price"))
            .select(by_consultant.alias("x_kind"), "x_id", "x_unit", F.lit(None).cast("date").alias("x_month"),
                    F.lit(None).cast("long").alias("project_id"), "price"))
    earning = (st.deliverable.select("deliverable_id", "project_id").join(p.filter(by_type), "project_id")
               .join(rate_by_project(st), "project_id", "left")
               .select(by_deliverable.alias("x_kind"), F.col("deliverable_id").cast("long").alias("x_id"), F.col("p_unit").alias("x_unit"),
                       F.col("p_month").alias("x_month"), "project_id", F.col("rate_sum").alias("price")))
    prices = paid.unionByName(earning)
    value, cost = (F.col("hours") * F.col("price")).cast(AMOUNT), F.col("kind") == by_consultant
    entries = (worked.join(prices, (F.col("kind") == F.col("x_kind")) & (F.col("id") == F.col("x_id")), "left")
               .filter(cost | F.col("x_kind").isNotNull())
               .select(F.col("x_unit").alias("unit_id"), F.when(cost, F.col("month")).otherwise(F.col("x_month")).alias("month"),
                       "project_id", F.when(cost, value).alias("total_billable_consultant_cost"),
                       F.when(~cost, value).alias("total_revenue")))

    fixed = (st.deliverable.groupBy("project_id").agg(_sum("price", "price"))
             .join(p.filter(sem.completed(F.col("status")) & (F.col("project_type") == TYPE_FIXED)), "project_id")
             .select(F.col("p_unit").alias("unit_id"), F.col("p_month").alias("month"), "project_id",
                     F.col("price").cast(AMOUNT).alias("total_revenue")))
    every = p.select(F.col("p_unit").alias("unit_id"), F.col("p_month").alias("month"), "project_id",
                     F.lit(0).cast(AMOUNT).alias("total_revenue"))
    return [(expenses, ["monthly_amount", "_anchor", "total_revenue"]),
            (entries, ["total_billable_consultant_cost", "total_revenue"]),
            (fixed.unionByName(every), ["total_revenue"])]


# --------------------------------------------------------------- HR / PM
def consultant_hours_month(st: Staged) -> DataFrame:
    """A14 + M8: hours (minutes / 60) per consultant and month, billable share."""
    g = (st.non_billable_hours.groupBy("consultant_id", F.col("month_start_date").alias("month"))
         .agg(F.sum("billable_minutes").alias("b"), F.sum("non_billable_minutes").alias("nb")))
    b = F.col("b").cast("double") / 60
    nb = F.col("nb").cast("double") / 60
    return g.select("consultant_id", "month", b.alias("billable_hours"),
                    nb.alias("non_billable_hours"), (b + nb).alias("total_hours"),
                    (b / F.nullif(b + nb, F.lit(0.0))).alias("billable_hours_percentage"))


def project_hours_month(st: Staged, only: DataFrame | None = None) -> DataFrame:
    """Hours per deliverable's project and work month."""
    return hours_by_project_month(st, only=only).withColumnRenamed("hours", "hours_spent")


def project_expense_month(st: Staged, only: DataFrame | None = None) -> DataFrame:
    """Expense per project and expense month (``only``: keep those
    (project_id, month) keys, filtered before the aggregation)."""
    pe = st.project_expense.withColumn("month", month_start("expense_date"))
    if only is not None:
        pe = pe.join(only, ["project_id", "month"], "left_semi")
    return (pe.groupBy("project_id", "month")
            .agg(F.sum("amount").cast(AMOUNT).alias("project_expenses_per_month")))


def consultant_cost_month(st: Staged, only: DataFrame | None = None) -> DataFrame:
    """Hours x every payroll amount of the consultant, per project and month."""
    hp = hours_by_project_month(st, "consultant_id", only=only)
    return (hp.join(payroll_by_consultant(st), "consultant_id", "left")
            .groupBy("project_id", "month")
            .agg(F.sum(F.col("hours") * F.col("amount_sum")).alias("consultant_hour_costs_per_month")))


def with_history(latest: DataFrame, st: Staged, sem: Semantics = Semantics(), since: dt.datetime | None = None) -> DataFrame:
    """``latest`` (one row for each project, or with ``since`` for each updated
    after it) with A10-A12 and A15-A17 as further columns.

    A project's latest month (of the row that ``latest_project`` takes) is one
    aggregate of its updates. Deliverables carry it to the entries; those of that
    month are priced by payroll where they stand, and one grouping sums the hours
    and costs of a project. Expenses meet it once. Entries and expenses of other
    projects are removed before they are reduced.
    """
    last = F.col("last_update")
    taken = F.lit(True) if since is None else F.coalesce(last > ntz(since), F.lit(False))
    at = (st.project.filter(F.col("project_id").isNotNull()).groupBy("project_id")
          .agg(F.max(F.when(taken, last)).alias("_last"), F.count_if(taken).alias("_taken"),
               F.count_if(taken & last.isNull()).alias("_undated"))
          .filter("_taken > 0"))
    month = month_start("_last")
    if sem.latest_nulls == "first":
        month = F.when(F.col("_undated") == 0, month)
    at = at.select("project_id", month.alias("_at"))
    now = F.coalesce(F.col("month") == F.col("_at"), F.lit(False))

    part_of = st.deliverable.select("deliverable_id", "project_id").join(at, "project_id")
    # hours outside the month have no consultant: their project spreads them over the tasks
    spread = F.when(~now, F.col("project_id"))
    paid = payroll_by_consultant(st).select(F.col("consultant_id").alias("p_id"), "amount_sum",
                                            F.lit(None).cast("long").alias("p_spread"))
    worked = (st.time_entry.select("deliverable_id", "consultant_id", month_start("work_date").alias("month"), "hours")
              .join(part_of, "deliverable_id")
              .select("project_id", now.alias("_now"), F.when(now, F.col("consultant_id")).alias("consultant_id"), "hours",
                      spread.alias("_spread"))
              .join(paid, (F.col("consultant_id") == F.col("p_id")) & F.col("_spread").eqNullSafe(F.col("p_spread")), "left")
              .groupBy("project_id")
              .agg(_sum("hours", "_hours"), F.sum(F.when(F.col("_now"), F.col("hours"))).alias("hours_spent"),
                   F.sum(F.when(F.col("_now"), F.col("hours") * F.col("amount_sum")))
                   .alias("consultant_hour_costs_per_month")))
    spent = (st.project_expense.select("project_id", month_start("expense_date").alias("month"), "is_billable", "amount")
             .join(at, "project_id").groupBy("project_id")
             .agg(F.sum(F.when(F.col("is_billable") == 1, F.col("amount"))).alias("total_tm_expense_revenue"),
                  F.sum(F.when(now, F.col("amount"))).cast(AMOUNT).alias("project_expenses_per_month")))
    prices = st.deliverable
    if since is not None:
        prices = prices.join(at, "project_id", "left_semi")
    priced = fixed_revenue_by_project(st.replace(deliverable=prices), sem)
    for past in (worked, spent, priced, rate_by_project(st)):
        latest = latest.join(past, "project_id", "left")
    return (latest.withColumn("total_tm_consultant_revenue", F.col("_hours") * F.col("rate_sum"))
            .drop("_hours", "rate_sum"))


def latest_project(projects: DataFrame, sem: Semantics = Semantics()) -> DataFrame:
    """The latest row per project by last_update.

    The source dialect sorts NULLs first under DESC, so a row with an unknown
    last_update wins unless ``latest_nulls='last'``. Ties are broken on the
    other columns so the choice is deterministic. Spark plans this as a
    partial + final WindowGroupLimit, so only one row per project per map
    task is shuffled.
    """
    lu = F.col("last_update")
    first = lu.desc_nulls_first() if sem.latest_nulls == "first" else lu.desc_nulls_last()
    tie = [F.col(c).desc_nulls_last() for c in ("created_at", "status", "percent_complete",
                                                  "actual_end_date", "actual_start_date")
           if c in projects.columns]
    w = Window.partitionBy("project_id").orderBy(first, *tie)
    return (projects.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .drop("_rn"))
