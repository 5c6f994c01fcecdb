import pytest
from pyspark.sql import functions as F

from practica.operators import measures as m
from practica.operators.staging import stage_all
from practica.oracle.queries_sql import measures as measure_sql
from practica.semantics import Semantics
from tests import tiny
from tests.literal import duck_over, rows_of

CASES = {
    "a1": lambda st: m.fixed_revenue_month(st),
    "a2": lambda st: m.expense_revenue_month(st),
    "a3": lambda st: m.consultant_revenue_month(st),
    "a4": lambda st: m.satisfaction_month(st),
    "a5": lambda st: m.fixed_incomplete_month(st),
    "a6": lambda st: m.tm_incomplete_month(st),
    "a7": lambda st: m.expense_unit_month(st),
    "a8": lambda st: m.direct_cost_unit_month(st),
    "a9": lambda st: m.indirect_cost_unit_month(st),
    "a13": lambda st: m.unit_revenue_month(st),
    "a14": lambda st: m.consultant_hours_month(st),
    "a15": lambda st: m.project_hours_month(st),
    "a16": lambda st: m.project_expense_month(st),
    "a17": lambda st: m.consultant_cost_month(st),
    "m5": lambda st: m.revenue_per_project(st),
    "spine": lambda st: m.activity_spine(st),
}


@pytest.fixture(scope="module")
def staged(spark):
    return stage_all(tiny.sources(spark))


@pytest.fixture(scope="module")
def con(staged):
    return duck_over(staged)


@pytest.mark.parametrize("name", sorted(CASES))
def test_measure_equals_literal_sql(staged, con, name):
    """Pre-aggregated Spark plans equal the fan-out-then-aggregate SQL."""
    ctes = measure_sql()
    sql = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + f"\nSELECT * FROM {name}"
    want = rows_of(con.sql(sql).fetchall())
    got = rows_of(CASES[name](staged).collect())
    assert got == want


def test_fan_out_semantics(staged):
    # consultant 500 has two payroll records (20 + 5): hours repeat per record
    a8 = {(r.unit_id, str(r.month)): r.total_billable_consultant_cost
          for r in m.direct_cost_unit_month(staged).collect()}
    assert float(a8[(1, "2024-01-01")]) == 2.0 * 25 + 4.0 * 30 + 1.0 * 30
    # consultant 502 has no payroll: its group exists with a NULL cost
    assert a8[(2, "2024-03-01")] is None
    # project 100 has two billing rates (100 + 50); hours without a rate -> NULL group
    a3 = {(r.client_id, r.unit_id, str(r.month)): r.total_tm_consultant_revenue
          for r in m.consultant_revenue_month(staged).collect()}
    assert float(a3[(10, 1, "2024-02-01")]) == (3.0 + 1.5) * 150
    assert a3[(None, None, "2024-01-01")] is None


def test_status_match_flag(staged):
    literal = Semantics(status_match="literal")
    assert m.fixed_revenue_month(staged, literal).count() == 0       # upper-cased never equals 'Completed'
    assert m.fixed_revenue_month(staged).count() > 0
    # '<>' drops NULL status in both modes
    inc = m.tm_incomplete_month(staged, literal).collect()
    assert {r.client_id for r in inc} == {11}


def test_billable_share_is_null_when_no_hours(staged):
    r = {(x.consultant_id, str(x.month)): x for x in m.consultant_hours_month(staged).collect()}
    assert r[(501, "2024-01-01")].billable_hours_percentage is None
    assert r[(500, "2024-01-01")].billable_hours == 2.0
    assert abs(r[(500, "2024-01-01")].billable_hours_percentage - 2 / 3) < 1e-12


def test_latest_project_null_first(spark, staged):
    p = staged.project
    dup = p.filter(F.col("project_id") == 101).withColumn("last_update", F.lit(None).cast("timestamp_ntz"))
    both = p.unionByName(dup)
    first = {r.project_id: r for r in m.latest_project(both).collect()}
    assert first[101].last_update is None                     # NULLs sort first under DESC
    last = {r.project_id: r for r in m.latest_project(both, Semantics(latest_nulls="last")).collect()}
    assert last[101].last_update is not None
    assert len(first) == 4
