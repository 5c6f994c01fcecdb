import datetime as dt

import pytest
from pyspark.sql import functions as F

from practica.operators.staging import stage_all
from practica.plans import facts
from practica.plans.marts import build_marts, snapshot_all
from practica.semantics import Semantics
from tests import tiny
from tests.literal import rows_of

SNAP = dt.datetime(2024, 6, 30)
SEM = Semantics(as_of=dt.date(2024, 6, 30))


@pytest.fixture(scope="module")
def world(spark):
    st = stage_all(tiny.sources(spark))
    return st, build_marts(snapshot_all(st, SNAP), SEM)


def test_finance_fact_rows_and_nulls(world):
    st, marts = world
    f = {(r.unit_key is None, str(r.date)): r for r in facts.finance_fact(st, marts, SEM).collect()}
    # the orphan expense forms a NULL-unit row with only its own amount
    orphan = f[(True, "2024-01-01")]
    assert float(orphan.direct_project_expenses) == 3.0
    assert orphan.direct_billable_consultant_cost is None and orphan.total_expenses is None
    # unit 2 has indirect cost in 2024-03 but no project expense: no row (anchor=expense)
    assert all(not (k[1] == "2024-03-01") for k in f)
    anyf = facts.finance_fact(st, marts, SEM.with_(anchor="any")).collect()
    assert any(str(r.date) == "2024-03-01" for r in anyf)


def test_finance_incremental_cutoff(world):
    st, marts = world
    full = facts.finance_fact(st, marts, SEM)
    batch = facts.finance_fact(st, marts, SEM, target=full)
    months = sorted({r.date for r in batch.collect()})
    assert months == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]   # latest month and the one before


def test_project_fact_measures(world):
    st, marts = world
    pf = {r.project_id: r for r in facts.project_fact(st, marts, SEM).collect()}
    a = pf[100]
    assert a.date == dt.date(2024, 2, 1) and a.if_late_start_flag == 1
    assert float(a.hours_spent) == 4.5                        # February hours only
    assert float(a.revenue_received_per_month) == 1500.0      # completed fixed: deliverable prices
    assert a.planned_duration_days == 90 and a.actual_duration_days == 77
    # expected end: start + round(days since start / percent)
    assert a.expected_end_date == dt.date(2024, 1, 3) + dt.timedelta(days=round(179 / 100))
    b = pf[101]
    # expected end 2024-01-10 + round(172 / 50) days is after the planned end
    assert b.expected_end_date == dt.date(2024, 1, 13) and b.potential_problem_project == 1
    assert b.actual_end_date_key is None
    assert pf[102].date is None and pf[102].row_key is not None
    keys = [r.row_key for r in pf.values()]
    assert len(set(keys)) == len(keys)


def test_business_dev_fact_grain(world):
    st, marts = world
    bd = facts.business_dev_fact(st, marts, SEM).collect()
    keys = [r.client_feedback_key for r in bd]
    assert len(set(keys)) == len(keys)                         # unique at client-unit-month
    jan = [r for r in bd if r.date == dt.date(2024, 1, 1)]
    assert jan and all(r.client_key is not None for r in jan)
    assert sum(float(r.revenue_received) for r in bd) == pytest.approx(
        1500.0 + 10.0 + (2.0 + 3.0 + 1.5) * 150)


def test_hr_rewrite_equals_literal_fan_out(world):
    """Each consultant-month with each deliverable worked on and each client
    of the unit's projects, as a set, is utilization joined to the two bridges."""
    st, marts = world

    def keyed(df, key, value):
        return {r[key]: r[value] for r in df.collect()}
    deliverable = keyed(marts.deliverable, "deliverable_id", "deliverable_key")
    client, unit_key = keyed(marts.client, "client_id", "client_key"), keyed(marts.business_unit, "unitid", "unitkey")
    unit_of = keyed(st.consultant, "consultant_id", "business_unit_id")
    minutes = {}
    for r in st.non_billable_hours.collect():
        total = minutes.setdefault((r.consultant_id, r.month_start_date), [0, 0])
        total[0] += r.billable_minutes
        total[1] += r.non_billable_minutes
    worked, clients = {}, {}
    for r in st.time_entry.collect():
        worked.setdefault(r.consultant_id, set()).add(r.deliverable_id)
    for r in st.project.collect():
        clients.setdefault(r.unit_id, set()).add(r.client_id)
    want = rows_of({
        (who, month, deliverable.get(d), unit_key.get(unit_of.get(who)), client.get(c),
         float(spent[0]) / 60, float(spent[1]) / 60)
        for (who, month), spent in minutes.items()
        for d in worked.get(who, {None})
        for c in (clients.get(unit_of.get(who), {None}) if unit_of.get(who) is not None else {None})})

    u = facts.hr_utilization(st, marts, SEM).alias("u")
    db = facts.hr_deliverable_bridge(st, marts, SEM).alias("db")
    cb = facts.hr_client_bridge(st, marts, SEM).alias("cb")
    j = (u.join(db, "consultant_id", "left")
         .join(cb, F.col("u.business_unit_id") == F.col("cb.business_unit_id"), "left"))
    got_df = (j.select("consultant_id", "snapshot_month", "deliverable_key", "u.business_unit_key", "client_key",
                       "billable_hours", "non_billable_hours").distinct())
    got = rows_of(got_df.collect())
    assert got == want
    assert len(want) > 0


def test_hr_title_as_of_month(world):
    st, marts = world
    u = {(r.consultant_id, r.date): r for r in facts.hr_utilization(st, marts, SEM).collect()}
    th = {r.id: r.titlehistory_key for r in marts.title_history.collect()}
    assert u[(500, dt.date(2024, 1, 1))].titlehistory_key == th[1]   # before the February change
    assert u[(500, dt.date(2024, 2, 1))].titlehistory_key == th[2]
    assert (502, None) in u and u[(502, None)].titlehistory_key is None  # month outside calendar


@pytest.mark.parametrize("builder,key", [
    (facts.finance_fact, "row_key"), (facts.business_dev_fact, "client_feedback_key"),
    (facts.hr_utilization, "HR_record_key"), (facts.project_fact, "row_key"),
])
def test_incremental_equals_full_refresh_within_lookback(spark, builder, key):
    """Changes that land in the lookback window: merge(target, batch) equals
    a full refresh on the changed inputs."""
    from practica.operators.incremental import merge_upsert
    rows = tiny.rows()
    before = stage_all(tiny.sources(spark))
    marts = build_marts(snapshot_all(before, SNAP), SEM)
    target = builder(before, marts, SEM)
    # February (the latest month) gains an expense, hours and a later project update
    rows["project_expense"] = rows["project_expense"] + [(9, 100, tiny.D("4.0000"), dt.date(2024, 2, 20), 1)]
    rows["consultant_deliverable"] = rows["consultant_deliverable"] + [
        (500, 1001, 7, tiny.D("2.00"), dt.date(2024, 2, 21))]
    rows["non_billable_hours"] = [(500, tiny.D("60.00"), tiny.D("60.00"), 202402) if r[3] == 202402 and r[0] == 500
                                  else r for r in rows["non_billable_hours"]]
    rows["project"] = [r[:15] + ("2024-02-20 08:00:00",) if r[0] == 100 else r for r in rows["project"]]
    after = stage_all(tiny.sources(spark, rows))
    full = builder(after, marts, SEM)
    merged = merge_upsert(target, builder(after, marts, SEM, target=target), key)
    assert rows_of(merged.select(*full.columns).collect()) == rows_of(full.collect())
