import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from practica.functions.keys import project_row_key, surrogate_key, ts_to_key
from practica.operators.calendar import date_dim
from practica.operators.staging import stage_all
from tests import tiny


def test_surrogate_key_known_answer(spark):
    row = spark.createDataFrame([(" A ", "b")], "a string, b string").select(
        surrogate_key(F.col("a"), F.col("b")).alias("k")).first()
    assert row.k == "66b69f6e54562b52ab37ccecbea18e40"  # md5('a|b|')


def test_surrogate_key_nulls_and_timestamps(spark):
    df = spark.createDataFrame([(None, dt.datetime(2024, 1, 6, 1, 2, 3, 456000))],
                               "a string, t timestamp_ntz")
    r = df.select(ts_to_key(F.col("t")).alias("txt"),
                  surrogate_key(F.col("a"), ts_to_key(F.col("t"))).alias("k"),
                  F.md5(F.lit("|2024-01-06t01:02:03456|")).alias("want")).first()
    assert r.txt == "2024-01-06T01:02:03456"
    assert r.k == r.want


def test_project_row_key_has_no_trailing_pipe(spark):
    r = spark.createDataFrame([(7, dt.date(2024, 2, 1))], "id long, m date").select(
        project_row_key(F.col("id"), F.col("m")).alias("k"), F.md5(F.lit("7|20240201")).alias("w")).first()
    assert r.k == r.w


def test_calendar_default_range_and_attributes(spark):
    cal = date_dim(spark, dt.date(2024, 1, 1), dt.date(2025, 12, 31))
    assert cal.count() == 731
    got = {r.date: r for r in cal.filter(F.col("date").isin(
        dt.date(2024, 1, 6), dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 12, 30))).collect()}
    sat, sun, mon = (got[dt.date(2024, 1, d)] for d in (6, 7, 8))
    assert (sat.day_of_week, sat.is_weekend, sat.day_name, sat.month_name) == (7, "Weekend", "Saturday", "January")
    assert (sun.day_of_week, sun.is_weekend) == (1, "Weekend")
    assert (mon.day_of_week, mon.is_weekend) == (2, "Weekday")
    assert got[dt.date(2024, 12, 30)].week == 1  # ISO week
    assert got[dt.date(2024, 12, 30)].quarter == 4


def test_stage_project_parses_leniently(spark):
    st = stage_all(tiny.sources(spark))
    p = {r.project_id: r for r in st.project.collect()}
    assert p[100].status == "COMPLETED" and p[100].project_name == "Alpha"
    assert p[100].planned_hours == Decimal("13")          # '12.5' rounds
    assert p[101].estimated_budget is None                 # 'n/a'
    assert p[103].estimated_budget is None                 # ''
    assert p[103].created_at is None                       # bad text
    assert p[103].planned_hours is None
    assert p[102].last_update is None and p[102].status is None
    assert p[100].last_update == dt.datetime(2024, 2, 15, 10, 0, 0)
    assert p[100].planned_start_date == dt.date(2024, 1, 1)


def test_stage_other_sources(spark):
    st = stage_all(tiny.sources(spark))
    nb = {(r.consultant_id, r.month_start_date) for r in st.non_billable_hours.collect()}
    assert (500, dt.date(2024, 2, 1)) in nb
    ta = {r.record_id: r for r in st.title_assignment.collect()}
    assert ta[1].end_date == dt.date(2024, 1, 15) and ta[2].end_date is None
    assert st.time_entry.schema["work_date"].dataType.simpleString() == "date"
