"""DuckDB oracle SQL, one statement per registered query.

Measures are grouped sums stated once each by ``grouped`` (input, keys, value)
over a few enriched inputs; the facts put their measures side by side and share
one projection for every variant. Parameters are the driver-table ones
(calendar 1995-2001, as-of and snapshot 2001-12-31).
"""

from __future__ import annotations

from practica.oracle.sources_sql import ctes

# Fixed parameters (mirror practica.semantics.DRIVER_SEMANTICS / SNAPSHOT_TS and
# the scenario constants of practica.plans.queries).
CAL_START, CAL_END = "DATE '1995-01-01'", "DATE '2001-12-31'"
AS_OF = "DATE '2001-12-31'"
SNAP_TS = "TIMESTAMP '2001-12-31 00:00:00'"
RUN1_TS, RUN2_TS = "TIMESTAMP '2001-06-30 00:00:00'", "TIMESTAMP '2001-12-31 00:00:00'"
MERGE_SPLIT = "DATE '2000-01-01'"
PROJECT_SPLIT = "TIMESTAMP '1999-01-01 00:00:00'"
COMPLETED = "'COMPLETED'"
PHONE = r"^\+?[0-9\s\-\(\)]+(x[0-9]+|ext\.?\s?[0-9]+)?\z"
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"


SOURCE_NAMES = ("businessunit", "client", "client_feedback", "consultant", "consultant_deliverable",
                "consultant_title_history", "deliverable", "indirect_cost", "non_billable_hours", "payroll",
                "project", "project_billing_rate", "project_expense", "title")


def sk(*exprs: str) -> str:
    return "md5(" + " || ".join(
        f"coalesce(lower(trim(CAST({e} AS VARCHAR))), '') || '|'" for e in exprs) + ")"


def ts_key(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%dT%H:%M:%S%g')"


def month(e: str) -> str:
    return f"CAST(date_trunc('month', {e}) AS DATE)"


CAL = (f"SELECT CAST(d AS DATE) AS date FROM "
       f"generate_series({CAL_START}, {CAL_END}, INTERVAL 1 DAY) AS g(d)")


def _hist(stg: str, cols: str = "*") -> str:
    return f"SELECT {cols}, {SNAP_TS} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM {stg}"


DIMS = {
    "cal": CAL,
    "h_bu": _hist("stg_businessunit"),
    "h_client": _hist("stg_client"),
    "h_consultant": _hist("stg_consultant"),
    "h_assign": _hist("stg_title_assignment"),
    "h_deliverable": _hist("stg_deliverable"),
    "h_project": _hist("stg_project", "project_id, client_id, unit_id, project_name, project_type, "
                                      "price, planned_start_date, planned_end_date"),
    "h_title": _hist("stg_title"),
    "dim_bu": f"""SELECT {sk('business_unit_id', ts_key('valid_from'))} AS unitkey,
        business_unit_id AS unitid, business_unit_name AS name, valid_from, valid_to FROM h_bu""",
    "dim_client": f"""SELECT {sk('client_id', ts_key('valid_from'))} AS client_key, client_id,
        client_name, phone_number, email, valid_from, valid_to FROM h_client""",
    "dim_consultant": f"""SELECT {sk('consultant_id', ts_key('valid_from'))} AS consultant_key,
        consultant_id, first_name, last_name, contact, valid_from, valid_to FROM h_consultant""",
    "dim_project": f"""SELECT {sk('project_id', ts_key('valid_from'))} AS project_key, project_id,
        project_type AS type, price, planned_start_date, planned_end_date, valid_from, valid_to
        FROM h_project""",
    "dim_deliverable": f"""SELECT {sk('deliverable_id', ts_key('vf'))} AS deliverable_key,
        deliverable_id, project_id, name, duedate, projectname, projecttype, vf AS valid_from,
        CASE WHEN vt = TIMESTAMP '9999-12-31 00:00:00' THEN NULL ELSE vt END AS valid_to
      FROM (SELECT d.deliverable_id, d.project_id, d.name, d.due_date AS duedate,
              p.project_name AS projectname, p.project_type AS projecttype,
              greatest(d.valid_from, p.valid_from) AS vf,
              least(coalesce(d.valid_to, TIMESTAMP '9999-12-31 00:00:00'),
                    coalesce(p.valid_to, TIMESTAMP '9999-12-31 00:00:00')) AS vt
            FROM h_deliverable d LEFT JOIN h_project p ON d.project_id = p.project_id
             AND greatest(d.valid_from, p.valid_from)
                 < least(coalesce(d.valid_to, TIMESTAMP '9999-12-31 00:00:00'),
                         coalesce(p.valid_to, TIMESTAMP '9999-12-31 00:00:00')))""",
    "dim_title_history": f"""SELECT {sk('id', ts_key('vf'))} AS titlehistory_key, id, consultant_id,
        title_id, title, startdate, enddate, vf AS valid_from,
        CASE WHEN vt = TIMESTAMP '9999-12-31 00:00:00' THEN NULL ELSE vt END AS valid_to
      FROM (SELECT a.record_id AS id, a.consultant_id, a.title_id, t.title_name AS title,
              a.start_date AS startdate, a.end_date AS enddate,
              greatest(a.valid_from, t.valid_from) AS vf,
              least(coalesce(a.valid_to, TIMESTAMP '9999-12-31 00:00:00'),
                    coalesce(t.valid_to, TIMESTAMP '9999-12-31 00:00:00')) AS vt
            FROM h_assign a LEFT JOIN h_title t ON a.title_id = t.title_id
             AND greatest(a.valid_from, t.valid_from)
                 < least(coalesce(a.valid_to, TIMESTAMP '9999-12-31 00:00:00'),
                         coalesce(t.valid_to, TIMESTAMP '9999-12-31 00:00:00')))""",
}


def grouped(source: str, keys: dict[str, str], value: str, name: str, where: str = "") -> str:
    """``value`` AS ``name`` for each combination of ``keys`` (alias -> expression)."""
    listed = ", ".join(f"{e} AS {k}" for k, e in keys.items())
    return f"SELECT {listed}, {value} AS {name} FROM {source}{' WHERE ' + where if where else ''} GROUP BY ALL"


STARTED = month("coalesce(actual_start_date, planned_start_date)")
CUM = ["client_id", "unit_id", "month"]


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def measures(pe: str = "stg_project_expense", proj: str = "stg_project",
             prefix: str = "", completed: str = COMPLETED) -> dict[str, str]:
    """Measure CTEs; ``pe``/``proj`` name the expense and project relations,
    ``prefix`` namespaces the CTE names so two variants can coexist."""
    P = prefix
    total = "CAST(sum({}) AS DECIMAL(18,2))".format
    body = {
        # enriched inputs
        "owner": f"SELECT project_id, client_id, unit_id, status, project_type FROM {proj}",
        "due": f"""SELECT project_id, client_id, unit_id, status, price, {month('due_date')} AS month
            FROM {P}owner INNER JOIN stg_deliverable USING (project_id) WHERE project_type = 'Fixed'""",
        "spent": f"""SELECT project_id, client_id, unit_id, is_billable, amount, {month('expense_date')} AS month
            FROM {pe} LEFT JOIN {P}owner USING (project_id)""",
        "worked": f"""SELECT consultant_id, project_id, hours, {month('work_date')} AS month
            FROM stg_time_entry LEFT JOIN (SELECT deliverable_id, project_id FROM stg_deliverable)
            USING (deliverable_id)""",
        "rates": grouped("stg_billing_rate", same("project_id"), total("rate"), "rate", "project_id IS NOT NULL"),
        "pays": grouped("stg_payroll", same("consultant_id"), total("amount"), "pay", "consultant_id IS NOT NULL"),
        # by client, unit and month; a rate decides whose hours they are
        "rated": f"""SELECT month, project_id, hours * rate AS worth,
            CASE WHEN rate IS NOT NULL THEN project_id END AS owner_id
            FROM {P}worked LEFT JOIN {P}rates USING (project_id)""",
        "a1": grouped(f"{P}due", same(*CUM), "sum(price)", "total_fp_revenue", f"status = {completed}"),
        "a2": grouped(f"{P}spent", same(*CUM), "sum(amount)", "total_tm_expense_revenue", "is_billable = 1"),
        "a3": grouped(f"{P}rated r LEFT JOIN {P}owner o ON o.project_id = r.owner_id", same(*CUM), "sum(worth)",
                      "total_tm_consultant_revenue"),
        "a4": grouped(f"stg_client_feedback f INNER JOIN {proj} j USING (project_id)",
                      {"client_id": "f.client_id", "unit_id": "j.unit_id", "month": STARTED},
                      "avg(overall_satisfaction)", "average_satisfaction"),
        "a5": grouped(f"{P}due", same(*CUM), "sum(price)", "incomplete_fp_revenue", f"status <> {completed}"),
        "a6": grouped(proj, {**same("client_id", "unit_id"), "month": STARTED},
                      "CAST(round(sum(coalesce(price, 0) * (100 - percent_complete) * 0.01::DECIMAL(3,2)), 2) "
                      "AS DECIMAL(38,2))", "incomplete_tm_revenue",
                      f"project_type = 'Time and Material' AND status <> {completed}"),
        # by unit and month
        "a7": grouped(f"{P}spent", same("unit_id", "month"), "sum(amount)", "monthly_amount"),
        "a8": grouped(f"{P}worked w LEFT JOIN {P}pays USING (consultant_id) "
                      "LEFT JOIN stg_consultant USING (consultant_id)",
                      {"unit_id": "business_unit_id", "month": "month"}, "sum(hours * pay)",
                      "total_billable_consultant_cost"),
        "a9": """SELECT business_unit_id AS unit_id, make_date(yearmonth // 100, yearmonth % 100, 1) AS month,
            sum(non_proj_labor_costs) AS total_non_proj_labor_costs,
            sum(other_expense_costs) AS total_other_expense_costs FROM stg_indirect_cost GROUP BY ALL""",
        # by project
        "a10": grouped(f"{P}due", same("project_id"), "sum(price)", "total_fp_revenue", f"status = {completed}"),
        "a11": grouped(pe, same("project_id"), "sum(amount)", "total_tm_expense_revenue", "is_billable = 1"),
        "a12": grouped(f"{P}rated", same("project_id"), "sum(worth)", "total_tm_consultant_revenue"),
        "earned": f"""SELECT project_id, CAST(CASE project_type
                WHEN 'Fixed' THEN coalesce(total_fp_revenue, 0)
                WHEN 'Time and Material'
                THEN coalesce(total_tm_expense_revenue, 0) + coalesce(total_tm_consultant_revenue, 0)
                ELSE 0 END AS DECIMAL(38,4)) AS revenue
            FROM {P}owner LEFT JOIN {P}a10 USING (project_id) LEFT JOIN {P}a11 USING (project_id)
            LEFT JOIN {P}a12 USING (project_id)""",
        "m5": f"""SELECT project_id, unit_id, {month('planned_start_date')} AS month,
            revenue AS total_project_revenue FROM {proj} INNER JOIN {P}earned USING (project_id)""",
        "a13": grouped(f"{P}m5", same("unit_id", "month"), "sum(total_project_revenue)", "total_revenue"),
        "a14": """SELECT consultant_id, month_start_date AS month,
            sum(billable_minutes)::DOUBLE / 60 AS billable_hours,
            sum(non_billable_minutes)::DOUBLE / 60 AS non_billable_hours,
            billable_hours + non_billable_hours AS total_hours,
            billable_hours / nullif(billable_hours + non_billable_hours, 0) AS billable_hours_percentage
            FROM stg_non_billable_hours GROUP BY ALL""",
        "a15": grouped(f"{P}worked", same("project_id", "month"), "sum(hours)", "hours_spent"),
        "a16": grouped(pe, {"project_id": "project_id", "month": month("expense_date")}, "sum(amount)",
                       "project_expenses_per_month"),
        "a17": grouped(f"{P}worked LEFT JOIN {P}pays USING (consultant_id)", same("project_id", "month"),
                       "sum(hours * pay)", "consultant_hour_costs_per_month"),
        "activity": " UNION ALL BY NAME ".join(f"SELECT * FROM {P}a{i}" for i in range(1, 7)),
        "spine": f"SELECT DISTINCT {', '.join(CUM)} FROM {P}activity WHERE client_id IS NOT NULL",
    }
    return {f"{P}{k}": v for k, v in body.items()}


def _wrap(extra: dict[str, str], final: str) -> str:
    return ctes(extra) + "\n" + final


def _measure_query(name: str, final: str | None = None) -> str:
    return _wrap({**DIMS, **measures()}, final or f"SELECT * FROM {name}")


# ------------------------------------------------------------------- facts
def finance_fact_ctes(prefix: str, pe: str = "stg_project_expense", anchor: str = "expense") -> dict[str, str]:
    """The finance fact as ``<prefix>_fact``: rows are the unit-months with
    expense, whose other measures need a known unit; or, for ``any``, all
    unit-months of any measure."""
    p, parts = prefix, ("a7", "a8", "a9", "a13")
    ms = measures(pe, prefix=f"{p}_")
    kept = "a7" if anchor == "expense" else None
    ms[f"{p}_side"] = " UNION ALL BY NAME ".join(
        f"SELECT *, {int(x == 'a7')} AS anchored FROM {p}_{x}" for x in parts)
    blank = "CASE WHEN unit_id IS NOT NULL THEN {} END".format if kept else "{}".format
    ms[f"{p}_row"] = f"""SELECT unit_id, month, max(anchored) AS anchored, sum(monthly_amount) AS expense,
        {blank('sum(total_billable_consultant_cost)')} AS staff,
        {blank('sum(total_non_proj_labor_costs)')} AS labor,
        {blank('sum(total_other_expense_costs)')} AS other, {blank('sum(total_revenue)')} AS revenue,
        expense + staff + labor + other AS outlay
        FROM {p}_side WHERE month BETWEEN {CAL_START} AND {CAL_END} GROUP BY unit_id, month"""
    money = {
        "direct_project_expenses": "expense", "direct_billable_consultant_cost": "staff",
        "total_direct_cost": "expense + staff", "indirect_nonbillable_consultant_cost": "labor",
        "indirect_other_expense_cost": "other", "total_indirect_costs": "labor + other",
        "total_expenses": "outlay", "total_revenue": "revenue", "profit": "revenue - outlay",
    }
    ms[f"{p}_fact"] = f"""SELECT {sk('unit_id', ts_key('month'))} AS row_key, unitkey AS unit_key,
        {', '.join(f'CAST({e} AS DECIMAL(38,4)) AS {n}' for n, e in money.items())}, month AS date
        FROM {p}_row LEFT JOIN (SELECT unitid, unitkey FROM dim_bu WHERE valid_to IS NULL) ON unitid = unit_id
        {'WHERE anchored = 1' if kept else ''}"""
    return ms


def _latest(src: str = "stg_project", where: str = "") -> str:
    order = ["last_update DESC NULLS FIRST", *[f"{c} DESC NULLS LAST" for c in (
        "created_at", "status", "percent_complete", "actual_end_date", "actual_start_date")]]
    return (f"SELECT * FROM {src} {'WHERE ' + where if where else ''} "
            f"QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY {', '.join(order)}) = 1")


def project_ctes(prefix: str = "", src: str = "stg_project", batch: str = "", fraction: bool = False,
                 open_only: bool = True) -> dict[str, str]:
    """The project fact as ``<prefix>project_fact``, of the projects in ``src``
    that satisfy ``batch``."""
    P, only = prefix, "WHERE valid_to IS NULL" if open_only else ""
    known = lambda day: f"CASE WHEN {day} BETWEEN {CAL_START} AND {CAL_END} THEN {day} END"
    pct = "nullif(percent_complete, 0)"
    days = f"date_diff('day', actual_start_date, {AS_OF})"
    rounded = f"round({days} * 100.0 / {pct}::DOUBLE)" if fraction else f"round({days} / {pct})"
    share = f"({pct}::DOUBLE / 100)" if fraction else f"{pct}::DOUBLE"
    money = {"hours_spent": "hours_spent", "project_expenses_per_month": "project_expenses_per_month",
             "consultant_hour_costs_per_month": "consultant_hour_costs_per_month", "total_expenses": "outlay"}
    return {
        f"{P}now": f"SELECT *, {month('last_update')} AS month FROM ({_latest(src, batch)})",
        f"{P}priced": grouped(f"{src} INNER JOIN stg_deliverable d USING (project_id)", same("project_id"),
                              "sum(d.price)", "total_fp_revenue",
                              f"project_type = 'Fixed' AND status = {COMPLETED}"),
        f"{P}past": f"""SELECT project_id, CAST(CASE project_type
                WHEN 'Fixed' THEN coalesce(price_sum, 0)
                WHEN 'Time and Material' THEN coalesce(billed, 0) + coalesce(worth, 0)
                ELSE 0 END AS DECIMAL(38,4)) AS revenue
            FROM {P}now
            LEFT JOIN (SELECT project_id, total_fp_revenue AS price_sum FROM {P}priced) USING (project_id)
            LEFT JOIN (SELECT project_id, total_tm_expense_revenue AS billed FROM a11) USING (project_id)
            LEFT JOIN (SELECT project_id, total_tm_consultant_revenue AS worth FROM a12) USING (project_id)""",
        f"{P}seen": f"""SELECT *,
            project_expenses_per_month + consultant_hour_costs_per_month AS outlay,
            CASE WHEN percent_complete > 0 THEN outlay::DOUBLE / {share} END AS forecasted_cost,
            CASE WHEN percent_complete > 0 THEN actual_start_date + CAST({rounded} AS INTEGER) END
              AS expected_end_date
            FROM {P}now LEFT JOIN {P}past USING (project_id)
            LEFT JOIN a15 USING (project_id, month) LEFT JOIN a16 USING (project_id, month)
            LEFT JOIN a17 USING (project_id, month)
            LEFT JOIN (SELECT project_id, project_key FROM dim_project {only}) USING (project_id)
            LEFT JOIN (SELECT client_id, client_key FROM dim_client {only}) USING (client_id)
            LEFT JOIN (SELECT unitid AS unit_id, unitkey AS business_unit_key FROM dim_bu {only}) USING (unit_id)""",
        f"{P}project_fact": f"""SELECT
            md5(concat_ws('|', coalesce(project_id::VARCHAR, ''), coalesce(strftime(month, '%Y%m%d'), '')))
              AS row_key,
            project_id, project_key, client_key, business_unit_key, month AS date,
            {known('actual_start_date')} AS actual_start_date_key, {known('actual_end_date')} AS actual_end_date_key,
            percent_complete, status, coalesce(actual_start_date > planned_start_date, false)::INTEGER
              AS if_late_start_flag,
            date_diff('day', planned_start_date, planned_end_date)::INTEGER AS planned_duration_days,
            date_diff('day', actual_start_date, actual_end_date)::INTEGER AS actual_duration_days,
            expected_end_date, {', '.join(f'CAST({e} AS DECIMAL(38,4)) AS {n}' for n, e in money.items())},
            forecasted_cost, CAST(revenue AS DECIMAL(38,4)) AS revenue_received_per_month,
            (coalesce(planned_end_date < expected_end_date, false) OR coalesce(CASE project_type
                WHEN 'Fixed' THEN forecasted_cost > price::DOUBLE
                WHEN 'Time and Material' THEN forecasted_cost > estimated_budget END, false))::INTEGER
              AS potential_problem_project,
            last_update
            FROM {P}seen""",
    }


def _project_fact_query(final: str = "SELECT * FROM project_fact", extra: dict | None = None, **kind) -> str:
    return _wrap({**DIMS, **measures(), **project_ctes(**kind), **(extra or {})}, final)


def bd_fact(prefix: str = "") -> str:
    """The business-development fact: the six measures side by side."""
    value = lambda *names: " + ".join(f"coalesce(sum({n}), 0)" for n in names)
    return f"""SELECT {sk('client_id', 'unit_id', ts_key('month'))} AS client_feedback_key, client_key,
        unitkey AS business_unit_key, month AS date, CAST(received AS DECIMAL(38,4)) AS revenue_received,
        average_satisfaction, CAST(forecast AS DECIMAL(38,4)) AS forecasted_future_revenue
      FROM (SELECT {', '.join(CUM)},
              {value('total_fp_revenue', 'total_tm_expense_revenue', 'total_tm_consultant_revenue')} AS received,
              sum(average_satisfaction) AS average_satisfaction,
              {value('incomplete_fp_revenue', 'incomplete_tm_revenue')} AS forecast
            FROM {prefix}activity WHERE month BETWEEN {CAL_START} AND {CAL_END} GROUP BY ALL)
      INNER JOIN (SELECT client_id, client_key FROM dim_client WHERE valid_to IS NULL) USING (client_id)
      LEFT JOIN (SELECT unitid, unitkey FROM dim_bu WHERE valid_to IS NULL) ON unitid = unit_id"""


HR_CTES = {
    "th": "SELECT * FROM dim_title_history WHERE valid_to IS NULL",
    "t_asof": """SELECT h.consultant_id, h.month, x.titlehistory_key,
        row_number() OVER (PARTITION BY h.consultant_id, h.month
                           ORDER BY x.startdate DESC, x.id DESC) AS rn
      FROM a14 h JOIN th x ON x.consultant_id = h.consultant_id AND x.startdate IS NOT NULL
       AND x.startdate <= last_day(h.month)""",
    "hr_util": f"""SELECT {sk('h.consultant_id', ts_key('h.month'))} AS HR_record_key,
        h.consultant_id, h.month AS snapshot_month, cd.consultant_key, c.business_unit_id,
        bd.unitkey AS business_unit_key,
        d.date, t.titlehistory_key, h.billable_hours, h.non_billable_hours, h.total_hours,
        h.billable_hours_percentage
      FROM a14 h
      LEFT JOIN dim_consultant cd ON h.consultant_id = cd.consultant_id AND cd.valid_to IS NULL
      LEFT JOIN stg_consultant c ON h.consultant_id = c.consultant_id
      LEFT JOIN dim_bu bd ON c.business_unit_id = bd.unitid AND bd.valid_to IS NULL
      LEFT JOIN cal d ON h.month = d.date
      LEFT JOIN t_asof t ON t.consultant_id = h.consultant_id AND t.month = h.month AND t.rn = 1""",
}


def _checks_sql(rows: list[tuple[str, str, str, str]]) -> str:
    """rows: (check, relation, column, SQL counting failures)."""
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"check\", '{r}' AS relation, '{col}' AS column_name, "
        f"CAST(({q}) AS BIGINT) AS failures" for c, r, col, q in rows)


def _cnt(rel: str, cond: str) -> str:
    return f"SELECT count(*) FROM {rel} WHERE {cond}"


def _dup(rel: str, col: str) -> str:
    return (f"SELECT count(*) FROM (SELECT {col} FROM {rel} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} HAVING count(*) > 1)")


def _orphans(rel: str, col: str, parent: str, pcol: str) -> str:
    return (f"SELECT count(*) FROM {rel} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} y WHERE y.{pcol} = x.{col})")


CATALOG_CTES = {
    "date_dim": f"""SELECT d AS date, CAST(year(d) AS INTEGER) AS year,
        CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
        monthname(d) AS month_name, dayname(d) AS day_name,
        CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week,
        CASE WHEN dayofweek(d) + 1 IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS is_weekend
      FROM (SELECT CAST(g AS DATE) AS d FROM generate_series({CAL_START}, {CAL_END}, INTERVAL 1 DAY) AS s(g))""",
    "bd_bu": "SELECT unitkey AS business_unit_key, unitid, name, valid_from, valid_to FROM dim_bu",
    "bd_fact": bd_fact(),
    "hr_db": """SELECT w.consultant_id, te.deliverable_id, dd.deliverable_key
      FROM (SELECT DISTINCT consultant_id FROM stg_non_billable_hours) w
      LEFT JOIN (SELECT DISTINCT consultant_id, deliverable_id FROM stg_time_entry) te
        ON w.consultant_id = te.consultant_id
      LEFT JOIN dim_deliverable dd ON te.deliverable_id = dd.deliverable_id AND dd.valid_to IS NULL""",
    "hr_cb": """SELECT p.unit_id AS business_unit_id, p.client_id, c.client_key
      FROM (SELECT DISTINCT unit_id, client_id FROM stg_project WHERE unit_id IS NOT NULL) p
      LEFT JOIN dim_client c ON p.client_id = c.client_id AND c.valid_to IS NULL""",
}

CATALOG_TABLES = {
    "bd_date_dim": "date_dim", "hr_date_dim": "date_dim", "project_date_dim": "date_dim",
    "bd_business_unit_dim": "bd_bu", "businessunit_dim": "dim_bu", "client_dim": "dim_client",
    "consultant_dim": "dim_consultant", "title_history_dim": "dim_title_history", "deliverable_dim": "dim_deliverable",
    "project_dim": "dim_project", "business_dev_fact": "bd_fact", "hr_utilization": "hr_util",
    "hr_deliverable_bridge": "hr_db", "hr_client_bridge": "hr_cb", "project_fact": "project_fact",
}


def _sql_lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def catalog_sql() -> str:
    """The declared-test catalog rendered as failure counts."""
    from practica.plans.check_catalog import CATALOG
    names = {"accepted": "accepted_values", "relationship": "relationships"}
    rows = []
    for rel, col, test, arg in CATALOG:
        t = CATALOG_TABLES[rel]
        if test == "not_null":
            n = _cnt(t, f"{col} IS NULL")
        elif test == "unique":
            n = _dup(t, col)
        elif test == "accepted":
            n = _cnt(t, f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(map(_sql_lit, arg))})")
        elif test == "relationship":
            n = _orphans(t, col, CATALOG_TABLES[arg[0]], arg[1])
        elif test == "between_0_and_100":
            n = _cnt(t, f"{col} < 0 OR {col} > 100")
        elif test in ("non_negative", "price_non_negative"):
            n = _cnt(t, f"{col} < 0")
        elif test == "end_after_start_or_null":
            n = _cnt(t, f"{col} IS NOT NULL AND {arg} IS NOT NULL AND {col} < {arg}")
        elif test == "end_strictly_after_start":
            n = _cnt(t, f"{col} IS NOT NULL AND {col} <= {arg}")
        elif test == "phone_pattern":
            n = _cnt(t, f"{col} IS NOT NULL AND NOT regexp_matches({col}, '{PHONE}')")
        elif test == "email_pattern":
            n = _cnt(t, f"{col} IS NOT NULL AND NOT regexp_matches({col}, '{EMAIL}')")
        else:
            raise ValueError(test)
        rows.append((names.get(test, test), rel, col, n))
    return _project_fact_query(_checks_sql(rows), extra={**HR_CTES, **CATALOG_CTES})


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["staging_project"] = _wrap({}, "SELECT * FROM stg_project")
    q["calendar"] = _wrap({}, """SELECT d AS date, CAST(year(d) AS INTEGER) AS year,
        CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
        monthname(d) AS month_name, dayname(d) AS day_name,
        CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week,
        CASE WHEN dayofweek(d) + 1 IN (1, 7) THEN 'Weekend' ELSE 'Weekday' END AS is_weekend
      FROM (SELECT CAST(g AS DATE) AS d FROM (
              SELECT min(x) AS lo, max(x) AS hi FROM (
                SELECT CAST(o_orderdate AS DATE) AS x FROM orders
                UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)) b,
            generate_series(CAST(date_trunc('year', b.lo) AS DATE),
                            CAST(date_trunc('year', b.hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE),
                            INTERVAL 1 DAY) AS s(g))""")
    q["surrogate_keys"] = _wrap({}, f"""SELECT project_id,
        {sk('project_id', ts_key('last_update'))} AS version_key,
        {sk('project_name', 'status', 'price')} AS text_key,
        {sk('unit_id', ts_key('planned_start_date'))} AS date_key FROM stg_project""")
    q["project_row_key"] = _wrap({}, f"""SELECT project_id,
        md5(concat_ws('|', coalesce(CAST(project_id AS VARCHAR), ''),
                           coalesce(strftime({month('last_update')}, '%Y%m%d'), ''))) AS row_key
      FROM stg_project""")
    simple = {
        "fixed_revenue_month": "a1", "expense_revenue_month": "a2", "consultant_revenue_month": "a3",
        "satisfaction_month": "a4", "fixed_incomplete": "a5", "tm_incomplete": "a6",
        "expense_unit_month": "a7", "direct_cost_unit_month": "a8", "indirect_cost_unit_month": "a9",
        "revenue_per_project": "m5", "unit_revenue": "a13", "consultant_hours": "a14",
        "project_hours": "a15", "project_expense_month": "a16", "consultant_cost_month": "a17",
        "activity_spine": "spine",
    }
    for name, cte in simple.items():
        q[name] = _measure_query(cte)
    q["latest_project"] = _wrap({"p2": """SELECT * FROM stg_project UNION ALL
        SELECT * REPLACE (last_update + INTERVAL 30 DAY AS last_update,
                          CAST(least(percent_complete + 1, 100) AS DECIMAL(5,2)) AS percent_complete)
        FROM stg_project WHERE project_id % 5 = 0"""}, _latest("p2"))
    q["scd2_client_two_runs"] = _wrap({
        "run1": "SELECT * FROM stg_client WHERE client_id % 13 <> 0",
        "run2": """SELECT client_id, client_name,
            CASE WHEN client_id % 3 = 0 THEN phone_number || ' x9' ELSE phone_number END AS phone_number,
            email FROM stg_client WHERE client_id % 11 <> 0""",
        "h1": f"SELECT *, {RUN1_TS} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM run1",
        "j": """SELECT h.client_id AS h_id, h.client_name AS h_name, h.phone_number AS h_phone,
              h.email AS h_email, h.valid_from AS h_from, h.valid_to AS h_to,
              r.client_id AS r_id, r.client_name AS r_name, r.phone_number AS r_phone, r.email AS r_email,
              h.client_id IS NOT NULL AND r.client_id IS NOT NULL AND NOT (
                h.client_name IS NOT DISTINCT FROM r.client_name
                AND h.phone_number IS NOT DISTINCT FROM r.phone_number
                AND h.email IS NOT DISTINCT FROM r.email) AS changed
            FROM h1 h FULL OUTER JOIN run2 r ON h.client_id = r.client_id""",
    }, f"""SELECT h_id AS client_id, h_name AS client_name, h_phone AS phone_number, h_email AS email,
          h_from AS valid_from, CASE WHEN changed THEN {RUN2_TS} ELSE h_to END AS valid_to
        FROM j WHERE h_id IS NOT NULL
        UNION ALL
        SELECT r_id, r_name, r_phone, r_email, {RUN2_TS}, CAST(NULL AS TIMESTAMP)
        FROM j WHERE r_id IS NOT NULL AND (h_id IS NULL OR changed)""")
    for name, cte in {"dim_project": "dim_project", "dim_client": "dim_client",
                      "dim_business_unit": "dim_bu", "dim_consultant": "dim_consultant",
                      "dim_deliverable": "dim_deliverable",
                      "dim_title_history": "dim_title_history"}.items():
        q[name] = _wrap(DIMS, f"SELECT * FROM {cte}")

    q["fact_finance"] = _wrap({**DIMS, **finance_fact_ctes("fin")}, "SELECT * FROM fin_fact")
    q["fact_business_dev"] = _wrap({**DIMS, **measures()}, bd_fact())
    q["fact_project"] = _project_fact_query()
    q["hr_utilization"] = _wrap({**DIMS, **measures(), **HR_CTES}, "SELECT * FROM hr_util")
    q["hr_deliverable_bridge"] = _wrap(DIMS, """SELECT w.consultant_id, te.deliverable_id, dd.deliverable_key
      FROM (SELECT DISTINCT consultant_id FROM stg_non_billable_hours) w
      LEFT JOIN (SELECT DISTINCT consultant_id, deliverable_id FROM stg_time_entry) te
        ON w.consultant_id = te.consultant_id
      LEFT JOIN dim_deliverable dd ON te.deliverable_id = dd.deliverable_id AND dd.valid_to IS NULL""")
    q["hr_client_bridge"] = _wrap(DIMS, """SELECT p.unit_id AS business_unit_id, p.client_id, c.client_key
      FROM (SELECT DISTINCT unit_id, client_id FROM stg_project WHERE unit_id IS NOT NULL) p
      LEFT JOIN dim_client c ON p.client_id = c.client_id AND c.valid_to IS NULL""")

    for f in ("businessunit", "client", "client_feedback", "consultant", "time_entry",
              "title_assignment", "deliverable", "indirect_cost", "non_billable_hours", "payroll",
              "billing_rate", "project_expense", "title"):
        q[f"staging_{f}"] = _wrap({}, f"SELECT * FROM stg_{f}")

    # Semantics variants
    q["tm_incomplete_literal_status"] = _wrap(measures(completed="'Completed'"), "SELECT * FROM a6")
    q["fact_finance_any_anchor"] = _wrap({**DIMS, **finance_fact_ctes("fin", anchor="any")},
                                         "SELECT * FROM fin_fact")
    q["fact_project_fraction"] = _project_fact_query(fraction=True)

    # two snapshot runs: every seventh project's price changes at the second
    two = {k: (v.replace(SNAP_TS, RUN1_TS) if k.startswith("h_") else v) for k, v in DIMS.items()}
    two["h_project"] = f"""
        SELECT project_id, client_id, unit_id, project_name, project_type, price,
               planned_start_date, planned_end_date, {RUN1_TS} AS valid_from,
               CASE WHEN project_id % 7 = 0 AND price IS NOT NULL THEN {RUN2_TS} END AS valid_to
        FROM stg_project
        UNION ALL
        SELECT project_id, client_id, unit_id, project_name, project_type,
               CAST(price + 1 AS DECIMAL(18,2)), planned_start_date, planned_end_date,
               {RUN2_TS}, CAST(NULL AS TIMESTAMP)
        FROM stg_project WHERE project_id % 7 = 0 AND price IS NOT NULL"""
    q["dim_deliverable_two_versions"] = _wrap(two, "SELECT * FROM dim_deliverable")
    q["fact_project_all_versions"] = _wrap({**two, **measures(), **project_ctes(open_only=False)},
                                           "SELECT * FROM project_fact")

    # I1 + I4: target from expenses before the split month, batch with a
    # one-month lookback from its own latest month, merged on row_key
    merge_ctes = {
        **DIMS,
        "pe_early": f"SELECT * FROM stg_project_expense WHERE expense_date < {MERGE_SPLIT}",
        **finance_fact_ctes("tgt", "pe_early"),
        **finance_fact_ctes("upd"),
        "upd_rows": """SELECT * FROM upd_fact
            WHERE date >= (SELECT CAST(max(date) - INTERVAL 1 MONTH AS DATE) FROM upd_fact)""",
    }
    q["merge_upsert_fact"] = _wrap(merge_ctes, """
        SELECT * FROM tgt_fact t WHERE NOT EXISTS (SELECT 1 FROM upd_rows u WHERE u.row_key = t.row_key)
        UNION ALL SELECT * FROM upd_rows""")
    # I1 + I3: HR target from hours before the split month, one-month lookback
    assert "FROM a14 h JOIN th x" in HR_CTES["t_asof"] and "FROM a14 h\n" in HR_CTES["hr_util"]
    hr_early = {
        "nbh_early": f"SELECT * FROM stg_non_billable_hours WHERE month_start_date < {MERGE_SPLIT}",
        "a14_early": measures()["a14"].replace("stg_non_billable_hours", "nbh_early"),
        "t_asof_early": HR_CTES["t_asof"].replace("FROM a14 h", "FROM a14_early h"),
        "hr_tgt": HR_CTES["hr_util"].replace("FROM a14 h", "FROM a14_early h")
                                    .replace("LEFT JOIN t_asof t", "LEFT JOIN t_asof_early t"),
        "hr_upd": """SELECT * FROM hr_util
            WHERE date >= (SELECT CAST(max(date) - INTERVAL 1 MONTH AS DATE) FROM hr_tgt)""",
    }
    q["merge_hr_utilization"] = _wrap({**DIMS, **measures(), **HR_CTES, **hr_early}, """
        SELECT * FROM hr_tgt t WHERE NOT EXISTS (SELECT 1 FROM hr_upd u WHERE u.HR_record_key = t.HR_record_key)
        UNION ALL SELECT * FROM hr_upd""")
    # The stored fact lacks a column that the batch has
    q["merge_schema_change"] = _wrap({**DIMS, **measures(), **HR_CTES, **hr_early}, """
        SELECT * REPLACE (NULL::DOUBLE AS billable_hours_percentage) FROM hr_tgt
        WHERE HR_record_key NOT IN (SELECT HR_record_key FROM hr_upd) UNION ALL SELECT * FROM hr_upd""")
    # I1 + I3 on the business-development fact (target from early expenses)
    q["merge_business_dev"] = _wrap({
        **DIMS, **measures(),
        "pe_early": f"SELECT * FROM stg_project_expense WHERE expense_date < {MERGE_SPLIT}",
        **measures(pe="pe_early", prefix="tgt_"),
        "bd_tgt": bd_fact("tgt_"), "bd_full": bd_fact(),
        "bd_upd": """SELECT * FROM bd_full
            WHERE date >= (SELECT CAST(max(date) - INTERVAL 1 MONTH AS DATE) FROM bd_tgt)""",
    }, """SELECT * FROM bd_tgt
          WHERE client_feedback_key NOT IN (SELECT client_feedback_key FROM bd_upd)
          UNION ALL SELECT * FROM bd_upd""")
    # The watermark is written out; late changes before it are not loaded
    q["cutoff_last_update"] = _project_fact_query(
        """SELECT * FROM old_project_fact WHERE row_key NOT IN (SELECT row_key FROM new_project_fact)
           UNION ALL SELECT * FROM new_project_fact""",
        extra={
            "before": f"""SELECT * REPLACE (CASE WHEN project_id % 10 = 0 THEN 50::DECIMAL(5,2)
                                            ELSE percent_complete END AS percent_complete)
                FROM stg_project WHERE last_update < {PROJECT_SPLIT} OR last_update IS NULL
                UNION ALL
                SELECT * REPLACE ({PROJECT_SPLIT} AS last_update) FROM stg_project
                WHERE project_id % 2 = 0 AND last_update >= {PROJECT_SPLIT}
                  AND last_update < TIMESTAMP '1999-02-01 00:00:00'""",
            **project_ctes("old_", src="before"),
            **project_ctes("new_", batch=f"last_update > {PROJECT_SPLIT}"),
        })
    # What two runs leave of each history, stated by key
    keys = {"businessunit": "business_unit_id", "client": "client_id", "consultant": "consultant_id",
            "title_assignment": "record_id", "deliverable": "deliverable_id", "project": "project_id",
            "title": "title_id"}
    # Checked columns of each history; the first named changes.
    checked = {
        "businessunit": ("business_unit_name", ["business_unit_name"]),
        "client": ("phone_number", ["client_name", "phone_number", "email"]),
        "consultant": ("contact", ["business_unit_id", "first_name", "last_name", "contact"]),
        "title_assignment": ("title_id", ["consultant_id", "title_id", "start_date", "end_date"]),
        "deliverable": ("name", ["project_id", "name", "price", "due_date"]),
        "project": ("project_name", ["client_id", "unit_id", "project_name", "project_type", "price",
                                     "planned_start_date", "planned_end_date"]),
        "title": ("title_name", ["title_name"]),
    }

    def values(name: str, changes: bool) -> str:
        column, cols = checked[name]
        new = f"coalesce({column}, 0) + 1" if name == "title_assignment" else f"coalesce({column}, '') || ' x9'"
        listed = [f"coalesce(CAST({new if changes and c == column else c} AS VARCHAR), '~')" for c in cols]
        return f"md5(concat_ws('|', {', '.join(listed)}))"
    q["scd2_all_two_runs"] = _wrap({"every": " UNION ALL ".join(
        f"SELECT '{n}' AS history, CAST({k} AS BIGINT) AS key_id, {values(n, False)} AS old, {values(n, True)} AS new "
        f"FROM stg_{n}" for n, k in keys.items())}, f"""
        SELECT history, key_id, {RUN1_TS} AS valid_from,
               CASE WHEN key_id % 3 = 0 AND key_id % 11 <> 0 THEN {RUN2_TS} END AS valid_to, old AS versioned
        FROM every WHERE key_id % 13 <> 0
        UNION ALL
        SELECT history, key_id, {RUN2_TS}, NULL, CASE WHEN key_id % 3 = 0 THEN new ELSE old END FROM every
        WHERE key_id % 11 <> 0 AND (key_id % 13 = 0 OR key_id % 3 = 0)""")
    q["staging_text_dates"] = _wrap({}, """
        SELECT 'time_entry' AS source, record_id AS key_id, work_date AS date FROM stg_time_entry
        UNION ALL SELECT 'deliverable', deliverable_id, due_date FROM stg_deliverable
        UNION ALL SELECT 'project_expense', record_id, expense_date FROM stg_project_expense""")

    # storage: what is read back equals what was computed
    q["sink_version"] = q["dim_business_unit"]
    q["sink_snapshot_parts"] = q["scd2_client_two_runs"]
    q["kept_reductions"] = _wrap({}, f"""
        SELECT 'time_entry' AS events, CAST(consultant_id AS BIGINT) AS key_0, CAST(deliverable_id AS BIGINT) AS key_1,
               {month('work_date')} AS month, CAST(sum(hours) AS DECIMAL(38,4)) AS total
        FROM stg_time_entry GROUP BY ALL
        UNION ALL
        SELECT 'project_expense', CAST(project_id AS BIGINT), CAST(is_billable AS BIGINT),
               {month('expense_date')}, CAST(sum(amount) AS DECIMAL(38,4))
        FROM stg_project_expense GROUP BY ALL""")
    q["source_registry"] = _wrap({}, " UNION ALL ".join(
        f"SELECT '{n}' AS source, count(*) AS n FROM src_{n}" for n in SOURCE_NAMES))
    q["date_dims"] = _wrap({"cal": CAL}, """
        SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name, dayname(date) AS day_name,
               CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(date) AS INTEGER) AS week,
               CASE WHEN dayofweek(date) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS is_weekend, mart
        FROM cal, (VALUES ('business_development'), ('financial_report'), ('hr'), ('project_management')) AS m(mart)""")

    pf, pd_ = "project_fact", "dim_project"
    q["check_not_null"] = _project_fact_query(_checks_sql(
        [("not_null", "project_fact", c, _cnt(pf, f"{c} IS NULL")) for c in
         ("row_key", "project_id", "project_key", "date", "percent_complete", "potential_problem_project")]
        + [("not_null", "project_dim", c, _cnt(pd_, f"{c} IS NULL")) for c in ("project_key", "project_id")]
        + [("not_null", "businessunit_dim", c, _cnt("dim_bu", f"{c} IS NULL")) for c in ("unitkey", "unitid", "name")]
        + [("not_null", "client_dim", c, _cnt("dim_client", f"{c} IS NULL"))
           for c in ("client_key", "client_id", "client_name")]))
    q["check_unique"] = _project_fact_query(_checks_sql([
        ("unique", "project_fact", "row_key", _dup(pf, "row_key")),
        ("unique", "project_dim", "project_key", _dup(pd_, "project_key")),
        ("unique", "businessunit_dim", "unitkey", _dup("dim_bu", "unitkey")),
        ("unique", "client_dim", "client_key", _dup("dim_client", "client_key")),
        ("unique", "deliverable_dim", "deliverable_key", _dup("dim_deliverable", "deliverable_key"))]))
    q["check_accepted"] = _project_fact_query(_checks_sql([
        ("accepted_values", "project_dim", "type",
         _cnt(pd_, "type IS NOT NULL AND type NOT IN ('Fixed', 'Time and Material')")),
        ("accepted_values", "project_fact", "if_late_start_flag",
         _cnt(pf, "if_late_start_flag IS NOT NULL AND if_late_start_flag NOT IN (0, 1)")),
        ("accepted_values", "project_fact", "potential_problem_project",
         _cnt(pf, "potential_problem_project IS NOT NULL AND potential_problem_project NOT IN (0, 1)"))]))
    q["check_relationships"] = _project_fact_query(_checks_sql([
        ("relationships", "project_fact", "project_key", _orphans(pf, "project_key", pd_, "project_key")),
        ("relationships", "project_fact", "client_key", _orphans(pf, "client_key", "dim_client", "client_key")),
        ("relationships", "project_fact", "business_unit_key",
         _orphans(pf, "business_unit_key", "dim_bu", "unitkey"))]))
    q["check_range"] = _project_fact_query(_checks_sql(
        [("between_0_and_100", "project_fact", "percent_complete",
          _cnt(pf, "percent_complete < 0 OR percent_complete > 100"))]
        + [("non_negative", "project_fact", c, _cnt(pf, f"{c} < 0")) for c in
           ("planned_duration_days", "actual_duration_days", "hours_spent", "project_expenses_per_month",
            "consultant_hour_costs_per_month", "total_expenses", "forecasted_cost",
            "revenue_received_per_month")]))
    q["check_catalog"] = catalog_sql()
    q["check_dates"] = _wrap(DIMS, _checks_sql([
        ("end_after_start_or_null", "project_dim", "planned_end_date",
         _cnt(pd_, "planned_end_date IS NOT NULL AND planned_start_date IS NOT NULL "
                   "AND planned_end_date < planned_start_date")),
        ("end_strictly_after_start", "project_dim", "planned_end_date",
         _cnt(pd_, "planned_end_date IS NOT NULL AND planned_end_date <= planned_start_date")),
        ("price_non_negative", "project_dim", "price", _cnt(pd_, "price < 0"))]))
    q["check_patterns"] = _wrap(DIMS, _checks_sql([
        ("phone_pattern", "client_dim", "phone_number",
         _cnt("dim_client", f"phone_number IS NOT NULL AND NOT regexp_matches(phone_number, '{PHONE}')")),
        ("email_pattern", "client_dim", "email",
         _cnt("dim_client", f"email IS NOT NULL AND NOT regexp_matches(email, '{EMAIL}')")),
        ("phone_pattern", "consultant_dim", "contact",
         _cnt("dim_consultant", f"contact IS NOT NULL AND NOT regexp_matches(contact, '{PHONE}')"))]))
    return q
