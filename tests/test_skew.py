"""Skewed inputs: one consultant and one project hold most of the time
entries. Results must equal the literal (fan-out) SQL exactly."""

import datetime as dt
from decimal import Decimal

import pytest

from practica.operators import measures as m
from practica.operators.staging import stage_all
from practica.oracle.queries_sql import measures as measure_sql
from practica.plans import facts
from practica.plans.marts import build_marts, snapshot_all
from practica.semantics import Semantics
from tests import tiny
from tests.literal import duck_over, rows_of


@pytest.fixture(scope="module")
def skewed(spark):
    rows = tiny.rows()
    hot = [(500, 1000 + (i % 2), 100 + i, Decimal(f"{1 + i % 7}.25"), dt.date(2024, 1 + i % 6, 1 + i % 28))
           for i in range(3000)]
    rows["consultant_deliverable"] = rows["consultant_deliverable"] + hot
    rows["payroll"] = rows["payroll"] + [(10 + i, Decimal("1.00"), 500, "2024-03-31") for i in range(20)]
    return stage_all(tiny.sources(spark, rows))


@pytest.mark.parametrize("name,fn", [
    ("a3", m.consultant_revenue_month), ("a8", m.direct_cost_unit_month),
    ("a15", m.project_hours_month), ("a17", m.consultant_cost_month),
])
def test_hot_keys_match_literal(skewed, name, fn):
    con = duck_over(skewed)
    sql = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in measure_sql().items()) + f"\nSELECT * FROM {name}"
    assert rows_of(fn(skewed).collect()) == rows_of(con.sql(sql).fetchall())


def test_hot_consultant_bridge_and_incremental(skewed):
    sem = Semantics(as_of=dt.date(2024, 6, 30))
    marts = build_marts(snapshot_all(skewed, dt.datetime(2024, 6, 30)), sem)
    bridge = facts.hr_deliverable_bridge(skewed, marts, sem).collect()
    assert sorted(r.deliverable_id for r in bridge if r.consultant_id == 500) == [1000, 1001]
    full = facts.hr_utilization(skewed, marts, sem)
    inc = facts.hr_utilization(skewed, marts, sem, target=full).collect()
    assert {r.date for r in inc} == {dt.date(2024, 1, 1), dt.date(2024, 2, 1)}
    assert all(r.date is not None for r in inc)      # months outside the calendar drop
