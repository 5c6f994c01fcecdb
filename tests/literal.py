"""Brute-force reference: run literal SQL over tiny staged tables in DuckDB.

The Spark operators rewrite the source SQL (aggregate before fan-out joins,
union-merge of measures, as-of joins); these helpers evaluate the source
shape directly on a handful of rows for comparison.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from practica.sources.tables import Staged

STAGED_VIEWS = {
    "stg_businessunit": "businessunit", "stg_client": "client", "stg_client_feedback": "client_feedback",
    "stg_consultant": "consultant", "stg_time_entry": "time_entry",
    "stg_title_assignment": "title_assignment", "stg_deliverable": "deliverable",
    "stg_indirect_cost": "indirect_cost", "stg_non_billable_hours": "non_billable_hours",
    "stg_payroll": "payroll", "stg_project": "project", "stg_billing_rate": "billing_rate",
    "stg_project_expense": "project_expense", "stg_title": "title",
}


def duck_over(st: Staged, extra: dict | None = None) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for view, field in STAGED_VIEWS.items():
        con.register(view, getattr(st, field).toArrow())
    for name, df in (extra or {}).items():
        con.register(name, df.toArrow())
    return con


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(records) -> list[tuple]:
    return sorted((tuple(canon(v) for v in r) for r in records), key=repr)
