"""Zone-independent keys, history guards, text dates, calendar range, pushed bounds."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from practica.functions.keys import project_row_key, surrogate_key, ts_to_key
from practica.operators.scd2 import SNAPSHOTS, scd2_snapshot
from practica.operators.staging import stage_all
from practica.plans import build, facts
from practica.plans.marts import build_marts, snapshot_all
from practica.semantics import Semantics
from practica.sources.schemas import SOURCE_SCHEMAS, SchemaMismatch, conform, read_sources
from tests import tiny

SEM = Semantics(as_of=dt.date(2024, 6, 30))


def test_keys_do_not_depend_on_the_zone(spark):
    found = set()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York", "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            df = spark.sql("""SELECT * FROM VALUES
                (1, TIMESTAMP_NTZ'2024-03-10 02:30:00', DATE'2018-11-04'),
                (2, TIMESTAMP_NTZ'2024-03-10 03:30:00.1234', DATE'2018-11-04'), (3, NULL, NULL) AS t(id, at, day)""")
            found.add(tuple(map(tuple, df.select("id", ts_to_key("at"), ts_to_key("day"),
                                                 surrogate_key(F.lit(1), ts_to_key("at")),
                                                 project_row_key("id", "day")).orderBy("id").collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(found) == 1
    rows = found.pop()
    assert [r[1] for r in rows] == ["2024-03-10T02:30:00000", "2024-03-10T03:30:00123", None]
    assert rows[0][2] == "2018-11-04T00:00:00000"


def clients(spark, *ids):
    return spark.createDataFrame([(i, f"c{i}", "1", "a@b.cc") for i in ids],
                                 "client_id long, client_name string, phone_number string, email string")


@pytest.mark.parametrize("ids,said", [((1, 1), "duplicate key"), ((1, None), "NULL key")])
def test_history_refuses_bad_keys(spark, ids, said):
    at, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    first = scd2_snapshot(clients(spark, 1), SNAPSHOTS["client"], at)
    for history in (None, first):
        with pytest.raises(PySparkException, match=said):
            scd2_snapshot(clients(spark, *ids), SNAPSHOTS["client"], later, history).collect()


@pytest.mark.parametrize("again", [dt.datetime(2024, 1, 1), dt.datetime(2023, 12, 31)])
def test_history_refuses_a_run_that_is_not_later(spark, again):
    first = scd2_snapshot(clients(spark, 1), SNAPSHOTS["client"], dt.datetime(2024, 1, 1))
    with pytest.raises(PySparkException, match="not later"):
        scd2_snapshot(clients(spark, 1, 2), SNAPSHOTS["client"], again, first).collect()


def test_dates_stored_as_text_or_as_dates(spark, tmp_path):
    src = tiny.sources(spark)
    staged = []
    for kind in ("date", "string"):
        for name in SOURCE_SCHEMAS:
            df = getattr(src, name)
            for f in SOURCE_SCHEMAS[name].fields:
                if f.dataType.simpleString() == "date":
                    df = df.withColumn(f.name, F.col(f.name).cast(kind))
            df.write.parquet(f"{tmp_path}/{kind}/{name}")
        st = stage_all(read_sources(spark, f"{tmp_path}/{kind}"))
        staged.append([sorted(map(str, getattr(st, n).collect())) for n in ("time_entry", "deliverable",
                                                                            "project_expense")])
    assert staged[0] == staged[1]
    with pytest.raises(SchemaMismatch):
        conform("project_expense", src.project_expense.withColumn("date", F.lit(1)))


def test_calendar_from_the_data_keeps_later_rows(spark):
    rows = tiny.rows()
    rows["project_expense"] = rows["project_expense"] + [(99, 100, tiny.D("5.0000"), dt.date(2031, 3, 4), 1)]
    st = stage_all(tiny.sources(spark, rows))
    start, end = build.calendar_of(st, dt.date(2024, 6, 30))
    assert end == dt.date(2031, 12, 31)
    sem = SEM.with_(calendar_start=start, calendar_end=end)
    marts = build_marts(snapshot_all(st, dt.datetime(2024, 6, 30)), sem)
    assert dt.date(2031, 3, 1) in {r.date for r in facts.finance_fact(st, marts, sem).collect()}
    assert build.outside_calendar(st, SEM)["project_expense.expense_date"] >= 1
    assert build.outside_calendar(st, sem) == {}


def test_an_empty_stored_fact_loads_everything_by_default(spark):
    st = stage_all(tiny.sources(spark))
    marts = build_marts(snapshot_all(st, dt.datetime(2024, 6, 30)), SEM)
    for builder in (facts.business_dev_fact, facts.hr_utilization):
        full = builder(st, marts, SEM)
        empty = full.filter("false")
        assert builder(st, marts, SEM, target=empty).count() >= full.filter("date is not null").count() > 0
        assert builder(st, marts, SEM.with_(empty_target="nothing"), target=empty).count() == 0


def test_month_bounds():
    sem = SEM.with_(calendar_start=dt.date(2024, 1, 15), calendar_end=dt.date(2024, 12, 10))
    assert sem.month_bounds() == (dt.date(2024, 2, 1), dt.date(2024, 12, 31))
    assert sem.month_bounds(dt.date(2024, 6, 1)) == (dt.date(2024, 6, 1), dt.date(2024, 12, 31))


def test_an_incremental_batch_pushes_its_date_bound_into_the_scans(spark, tmp_path):
    src = tiny.sources(spark)
    for name in SOURCE_SCHEMAS:
        getattr(src, name).write.parquet(f"{tmp_path}/{name}")
    st = stage_all(read_sources(spark, str(tmp_path)))
    marts = build_marts(snapshot_all(st, dt.datetime(2024, 6, 30)), SEM)
    target = facts.business_dev_fact(st, marts, SEM)
    for builder, need in ((facts.business_dev_fact, 3), (facts.finance_fact, 2)):
        plan = builder(st, marts, SEM, target=target)._jdf.queryExecution().executedPlan().toString()
        pushed = [line for line in plan.split("PushedFilters: ")[1:] if "GreaterThanOrEqual" in line.split("ReadSchema")[0]]
        assert len(pushed) >= need, plan
