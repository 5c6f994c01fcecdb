"""Tiny hand-written source rows; each row exists for one trap.

Dates are text where the source schema declares text, DATE objects where it
declares DATE.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from practica.sources.schemas import SOURCE_SCHEMAS
from practica.sources.tables import Sources

d = dt.date


def rows() -> dict[str, list[tuple]]:
    return {
        "businessunit": [(1, "North"), (2, "South")],
        "client": [(10, "Acme", "555-1234 x12", "a@acme.com"),
                   (11, "Bolt", "+1 (02) 555", "bolt-at-example"),
                   (12, "Core", "bad#", None),
                   (13, "Dyna", "555-0000\n", "d@dyna.io")],
        "client_feedback": [(1, 10, 100, 4), (2, 10, 100, 5), (3, 11, 101, 2), (4, 12, 999, 3)],
        "consultant": [(500, 1, "Ann", "Lee", "555-1111"), (501, 1, "Bo", "Ma", "ext 9"),
                       (502, 2, "Cy", "No", None)],
        # consultant, deliverable, record, hours, date
        "consultant_deliverable": [
            (500, 1000, 1, D("2.00"), d(2024, 1, 10)),
            (500, 1000, 2, D("3.00"), d(2024, 2, 5)),
            (500, 1001, 3, D("1.50"), d(2024, 2, 6)),
            (501, 1002, 4, D("4.00"), d(2024, 1, 20)),   # project without a billing rate
            (501, 9999, 5, D("1.00"), d(2024, 1, 21)),   # orphan deliverable
            (502, 1003, 6, D("5.00"), d(2024, 3, 1)),    # consultant without payroll
        ],
        # record, consultant, title, start, last_update(-> end_date)
        "consultant_title_history": [
            (1, 500, 1, "2023-01-01", "2024-01-15"),
            (2, 500, 2, "2024-02-01", None),
            (3, 501, 3, "2024-01-01", None),            # title missing from Title
            (4, 502, 1, "2025-06-01", None),            # starts after every month
        ],
        # deliverable, project, name, price, due
        "deliverable": [
            (1000, 100, "Design", D("1000.00"), d(2024, 1, 31)),
            (1001, 100, "Build", D("500.00"), d(2024, 2, 28)),
            (1002, 101, "Audit", D("300.00"), d(2024, 1, 31)),
            (1003, 102, "Study", D("200.00"), d(2023, 6, 30)),   # outside the calendar
            (1004, 777, "Orphan", D("50.00"), d(2024, 1, 31)),   # unknown project
        ],
        "indirect_cost": [(1, 202401, D("100.00"), D("10.0000")),
                          (2, 202403, D("50.00"), D("5.0000"))],        # no project expense
        "non_billable_hours": [(500, D("120.00"), D("60.00"), 202401),
                               (500, D("60.00"), D("0.00"), 202402),
                               (501, D("0.00"), D("0.00"), 202401),    # share NULL
                               (502, D("30.00"), D("30.00"), 202301)],  # outside calendar
        "payroll": [(1, D("20.00"), 500, "2024-01-31"), (2, D("5.00"), 500, "2024-02-29"),
                    (3, D("30.00"), 501, "2024-01-31")],
        # id, created, client, unit, name, type, price, budget, hours, pstart, pend,
        # status, astart, aend, progress, last_update
        "project": [
            (100, "2023-12-01 00:00:00", 10, 1, " Alpha ", "Fixed", D("2000.00"), "2500", "12.5",
             "2024-01-01", "2024-03-31", " completed ", "2024-01-03", "2024-03-20", D("100.00"),
             "2024-02-15 10:00:00"),
            (101, "2023-12-02 00:00:00", 11, 1, "Beta", "Time and Material", D("800.00"), "n/a", "40",
             "2024-01-01", "2024-01-01", "Active", "2024-01-10", None, D("50.00"),
             "2024-01-20 09:00:00"),
            (102, "2023-12-03 00:00:00", 12, 2, "Gamma", "Time and Material", None, "100", "7",
             "2024-02-01", "2024-01-15", None, None, None, None, None),
            (103, "not a date", 10, 2, "Delta", "Retainer", D("10.00"), "", "x",
             "2024-01-01", None, "ON HOLD", "2024-01-05", None, D("0.00"), "2024-01-07 00:00:00"),
        ],
        "project_billing_rate": [(D("100.00"), 1, 100), (D("50.00"), 2, 100)],
        # record, project, amount, date, billable
        "project_expense": [
            (1, 100, D("10.0000"), d(2024, 1, 5), 1),
            (2, 100, D("20.0000"), d(2024, 2, 5), 0),
            (3, 101, D("7.5000"), d(2024, 1, 9), None),
            (4, 888, D("3.0000"), d(2024, 1, 9), 1),    # orphan project: NULL unit row
        ],
        "title": [(1, "Analyst"), (2, "Manager")],
    }


def sources(spark, overrides: dict[str, list[tuple]] | None = None) -> Sources:
    r = {**rows(), **(overrides or {})}
    return Sources(**{n: spark.createDataFrame(r[n], SOURCE_SCHEMAS[n]) for n in SOURCE_SCHEMAS})
