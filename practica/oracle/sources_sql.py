"""DuckDB twin of ``practica.sources.driver_tables`` and ``operators.staging``.

CTE text over the driver views (region nation customer supplier orders
lineitem). ``ctes()`` returns ``WITH <sources>, <staging>`` ready for a
query's own CTEs; DuckDB inlines the CTEs a query does not use away.
"""

from __future__ import annotations


def _ts(col: str) -> str:
    return f"strftime(CAST({col} AS DATE), '%Y-%m-%d')"


def _plus_days(col: str, days: str) -> str:
    return f"strftime(CAST({col} AS DATE) + CAST({days} AS INTEGER), '%Y-%m-%d')"


DID = "CAST(l_orderkey * 10 + l_linenumber AS BIGINT)"

SOURCES = {
    "src_businessunit": """
SELECT CAST(n_nationkey AS BIGINT) AS businessunitID, n_name AS business_unit_name FROM nation""",
    "src_client": """
SELECT c_custkey AS CLIENTID, c_name AS CLIENT_NAME,
       '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
         || CASE WHEN c_custkey % 10 = 0 THEN ' bad#' ELSE '' END AS PHONE_NUMBER,
       lower(replace(c_name, '#', '.'))
         || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '@example.com' END AS EMAIL
FROM customer""",
    "src_consultant": """
SELECT s_suppkey AS ConsultantID, CAST(s_nationkey AS BIGINT) AS BusinessUnitID,
       string_split(s_name, '#')[1] AS First_Name,
       string_split(s_name, '#')[-1] AS Last_Name,
       CASE WHEN s_suppkey % 9 = 0 THEN 'ext ' || CAST(s_suppkey AS VARCHAR)
            ELSE '+1 (555) ' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0')
                 || CASE WHEN s_suppkey % 4 = 0 THEN ' x' || CAST(s_suppkey % 100 AS VARCHAR) ELSE '' END
       END AS Contact
FROM supplier""",
    "src_title": """
SELECT CAST(r_regionkey AS BIGINT) AS titleid, r_name AS title_name FROM region""",
    "src_consultant_title_history": f"""
SELECT s_suppkey AS RECORDID, s_suppkey AS CONSULTANTID, s_suppkey % 5 AS TITLEID,
       {_plus_days("DATE '1995-01-01'", "s_suppkey")} AS START_DATE,
       CASE WHEN s_suppkey % 2 = 0 THEN NULL
            ELSE {_plus_days("DATE '1995-01-01'", "s_suppkey + 400")} END AS LAST_UPDATE
FROM supplier
UNION ALL
SELECT s_suppkey + 1000000, s_suppkey, (s_suppkey + 2) % 5,
       {_plus_days("DATE '1998-01-01'", "s_suppkey")}, CAST(NULL AS VARCHAR)
FROM supplier WHERE s_suppkey % 3 = 0""",
    "src_project": f"""
SELECT o_orderkey AS projectID,
       CAST(o_orderdate AS VARCHAR) AS created_at,
       o_custkey AS clientID,
       CAST(c_nationkey AS BIGINT) AS unitID,
       ' Project ' || CAST(o_orderkey AS VARCHAR) || ' ' AS name,
       CASE WHEN o_orderkey % 211 = 0 THEN ' Retainer '
            WHEN o_orderkey % 2 = 0 THEN 'Fixed' ELSE 'Time and Material' END AS type,
       CAST(o_totalprice AS DECIMAL(18,2)) AS price,
       CASE WHEN o_orderkey % 11 = 0 THEN 'n/a'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS estimated_budget,
       CAST(o_orderkey % 400 AS VARCHAR) || CASE WHEN o_orderkey % 9 = 0 THEN '.5' ELSE '' END
         AS planned_hours,
       {_ts("o_orderdate")} AS planned_start_date,
       {_plus_days("o_orderdate", "90")} AS planned_end_date,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 13 = 0 THEN ' completed '
            WHEN o_orderstatus = 'F' THEN 'Completed'
            WHEN o_orderstatus = 'O' THEN 'Active'
            WHEN o_orderstatus = 'P' THEN ' on hold ' END AS status,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE {_plus_days("o_orderdate", "o_orderkey % 15")} END AS actual_start_date,
       CASE WHEN o_orderstatus = 'F' THEN {_plus_days("o_orderdate", "o_orderkey % 15 + 80")}
            ELSE NULL END AS actual_end_date,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 100 WHEN o_orderstatus = 'O' THEN o_orderkey % 100
                 WHEN o_orderstatus = 'P' THEN 0 END AS DECIMAL(5,2)) AS progress,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            ELSE {_plus_days("o_orderdate", "o_orderkey % 120")} || ' '
                 || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':15:30' END AS last_update
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "src_deliverable": f"""
SELECT {DID} AS DELIVERABLEID, l_orderkey AS PROJECTID,
       'Deliverable ' || CAST({DID} AS VARCHAR) AS NAME,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS PRICE,
       CAST(max(l_shipdate) AS DATE) AS DUE_DATE
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
    "src_consultant_deliverable": f"""
SELECT l_suppkey AS consultantid, {DID} AS deliverableid, {DID} AS recordid,
       CAST(l_quantity AS DECIMAL(18,2)) AS hours, CAST(l_shipdate AS DATE) AS "DATE"
FROM lineitem""",
    "src_project_expense": f"""
SELECT {DID} AS recordid, l_orderkey AS projectid,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))
            AS DECIMAL(18,4)) AS amount,
       CAST(l_shipdate AS DATE) AS "date",
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS is_billable
FROM lineitem""",
    "src_payroll": """
SELECT s_suppkey * 10 + 1 AS RECORDID, CAST(20 + s_suppkey % 30 AS DECIMAL(18,2)) AS AMOUNT,
       s_suppkey AS CONSULTANTID, '2001-12-31' AS payment_date FROM supplier
UNION ALL
SELECT s_suppkey * 10 + 2, CAST(5 AS DECIMAL(18,2)), s_suppkey, '2001-12-31'
FROM supplier WHERE s_suppkey % 4 = 0""",
    "src_project_billing_rate": """
SELECT CAST(50 + o_orderkey % 50 AS DECIMAL(18,2)) AS RATE, o_orderkey % 5 AS TITLEID,
       o_orderkey AS PROJECTID FROM orders WHERE o_orderkey % 17 <> 0
UNION ALL
SELECT CAST(75 AS DECIMAL(18,2)), (o_orderkey + 1) % 5, o_orderkey
FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 3 = 0""",
    "src_non_billable_hours": """
SELECT l_suppkey AS consultantid,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) * 60 AS DECIMAL(18,2)) AS "BILLABLE HOURS",
       CAST(sum(l_linenumber) * 60 AS DECIMAL(18,2)) AS "TABLE NONBILLABLEHOURS",
       CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS yearmonth
FROM lineitem GROUP BY l_suppkey, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER)""",
    "src_indirect_cost": """
SELECT CAST(c_nationkey AS BIGINT) AS business_unit_id,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS yearmonth,
       CAST(count(*) * 100 AS DECIMAL(18,2)) AS non_proj_labor_costs,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,4))
         AS other_expense_costs
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY CAST(c_nationkey AS BIGINT), CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER)""",
    "src_client_feedback": """
SELECT o_orderkey AS RESPONSE_ID, o_custkey AS CLIENT_ID, o_orderkey AS PROJECT_ID,
       CAST(1 + o_orderkey % 5 AS INTEGER) AS OVERALL_SATISFACTION
FROM orders WHERE o_orderstatus = 'F'""",
}

STAGING = {
    "stg_businessunit": "SELECT businessunitID AS business_unit_id, business_unit_name FROM src_businessunit",
    "stg_client": """SELECT CLIENTID AS client_id, CLIENT_NAME AS client_name,
       PHONE_NUMBER AS phone_number, EMAIL AS email FROM src_client""",
    "stg_client_feedback": """SELECT RESPONSE_ID AS response_id, CLIENT_ID AS client_id,
       PROJECT_ID AS project_id, OVERALL_SATISFACTION AS overall_satisfaction FROM src_client_feedback""",
    "stg_consultant": """SELECT ConsultantID AS consultant_id, BusinessUnitID AS business_unit_id,
       First_Name AS first_name, Last_Name AS last_name, Contact AS contact FROM src_consultant""",
    "stg_time_entry": """SELECT consultantid AS consultant_id, deliverableid AS deliverable_id,
       recordid AS record_id, hours, CAST("DATE" AS DATE) AS work_date FROM src_consultant_deliverable""",
    "stg_title_assignment": """SELECT RECORDID AS record_id, CONSULTANTID AS consultant_id,
       TITLEID AS title_id, CAST(START_DATE AS DATE) AS start_date, CAST(LAST_UPDATE AS DATE) AS end_date
       FROM src_consultant_title_history""",
    "stg_deliverable": """SELECT DELIVERABLEID AS deliverable_id, PROJECTID AS project_id, NAME AS name,
       PRICE AS price, CAST(DUE_DATE AS DATE) AS due_date FROM src_deliverable""",
    "stg_indirect_cost": """SELECT business_unit_id, yearmonth, non_proj_labor_costs, other_expense_costs
       FROM src_indirect_cost""",
    "stg_non_billable_hours": """SELECT consultantid AS consultant_id,
       "BILLABLE HOURS" AS billable_minutes, "TABLE NONBILLABLEHOURS" AS non_billable_minutes,
       CAST(strptime(CAST(yearmonth AS VARCHAR) || '01', '%Y%m%d') AS DATE) AS month_start_date
       FROM src_non_billable_hours""",
    "stg_payroll": """SELECT RECORDID AS record_id, AMOUNT AS amount, CONSULTANTID AS consultant_id,
       payment_date FROM src_payroll""",
    "stg_project": """SELECT projectID AS project_id,
       TRY_CAST(created_at AS TIMESTAMP) AS created_at,
       clientID AS client_id, unitID AS unit_id,
       trim(name) AS project_name, trim(type) AS project_type, price,
       TRY_CAST(estimated_budget AS DOUBLE) AS estimated_budget,
       TRY_CAST(planned_hours AS DECIMAL(38,0)) AS planned_hours,
       CAST(planned_start_date AS DATE) AS planned_start_date,
       CAST(planned_end_date AS DATE) AS planned_end_date,
       upper(trim(status)) AS status,
       CAST(actual_start_date AS DATE) AS actual_start_date,
       CAST(actual_end_date AS DATE) AS actual_end_date,
       progress AS percent_complete,
       TRY_CAST(last_update AS TIMESTAMP) AS last_update
       FROM src_project""",
    "stg_billing_rate": """SELECT RATE AS rate, TITLEID AS title_id, PROJECTID AS project_id
       FROM src_project_billing_rate""",
    "stg_project_expense": """SELECT recordid AS record_id, projectid AS project_id, amount,
       CAST("date" AS DATE) AS expense_date, is_billable FROM src_project_expense""",
    "stg_title": "SELECT titleid AS title_id, title_name FROM src_title",
}


def ctes(extra: dict[str, str] | None = None) -> str:
    parts = {**SOURCES, **STAGING, **(extra or {})}
    return "WITH " + ",\n".join(f"{name} AS ({body.strip()})" for name, body in parts.items())
