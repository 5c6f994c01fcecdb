import datetime as dt

import pytest
from pyspark.sql import functions as F

from practica.operators import quality as q
from practica.operators.incremental import (merge_upsert, read_current, sync_columns,
                                            write_version)
from practica.operators.scd2 import DuplicateKeyError

TGT = "row_key string, v int, old_col string"
UPD = "row_key string, v int, new_col string"


def test_merge_replaces_inserts_and_syncs_columns(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], TGT)
    updates = spark.createDataFrame([("b", 20, "n"), ("c", 3, "m")], UPD)
    merged = merge_upsert(target, updates, "row_key")
    assert merged.columns == ["row_key", "v", "new_col"]            # schema follows the updates
    got = {r.row_key: (r.v, r.new_col) for r in merged.collect()}
    assert got == {"a": (1, None), "b": (20, "n"), "c": (3, "m")}
    again = merge_upsert(merged, updates, "row_key")                # idempotent
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_merge_refuses_duplicate_keys(spark):
    target = spark.createDataFrame([("a", 1, "x")], TGT)
    updates = spark.createDataFrame([("b", 1, "n"), ("b", 2, "m")], UPD)
    with pytest.raises(DuplicateKeyError):
        merge_upsert(target, updates, "row_key")


def test_merge_into_empty_target(spark):
    empty = spark.createDataFrame([], TGT)
    updates = spark.createDataFrame([("c", 3, "m")], UPD)
    assert merge_upsert(empty, updates, "row_key").count() == 1
    assert merge_upsert(None, updates, "row_key").count() == 1
    assert sync_columns(empty, updates).columns == updates.columns


def test_versioned_write_never_overwrites_what_it_reads(spark, tmp_path):
    root = str(tmp_path / "fact")
    assert read_current(spark, root) is None
    first = spark.createDataFrame([("a", 1, "x")], UPD)
    write_version(first, root)
    cur = read_current(spark, root)
    nxt = merge_upsert(cur, spark.createDataFrame([("a", 5, "z"), ("b", 2, "y")], UPD), "row_key")
    p2 = write_version(nxt, root)                                     # reads v=1, writes v=2
    assert p2.endswith("v=2")
    assert {r.row_key: r.v for r in read_current(spark, root).collect()} == {"a": 5, "b": 2}


def test_pattern_checks(spark):
    df = spark.createDataFrame([("555-1234 x12", "a@b.io"), ("+1 (02) 555", "bad-at"),
                                ("bad#", None), ("555-0000\n", "x@y.com\n"),
                                ("555 ext. 44", "u.v+w@d-e.org")],
                               "phone string, email string")
    s = {(r.check, r.column_name): r.failures for r in q.summarize([
        q.phone_pattern("t", df, "phone"), q.email_pattern("t", df, "email")]).collect()}
    assert s[("phone_pattern", "phone")] == 1      # 'bad#' ('\s' in the class admits a newline)
    assert s[("email_pattern", "email")] == 2      # 'bad-at' and the trailing newline


def test_generic_checks(spark):
    df = spark.createDataFrame([(1, 50, 0, dt.date(2024, 1, 1), dt.date(2024, 1, 1)),
                                (1, 101, 2, dt.date(2024, 1, 2), dt.date(2024, 1, 1)),
                                (None, -1, 1, None, dt.date(2024, 1, 1))],
                               "k long, pct int, flag int, e date, s date")
    parent = spark.createDataFrame([(1,)], "k long")
    s = {(r.check, r.column_name): r.failures for r in q.summarize([
        q.not_null("t", df, "k"), q.unique("t", df, "k"), q.between_0_and_100("t", df, "pct"),
        q.non_negative("t", df, "pct"), q.accepted_values("t", df, "flag", [0, 1]),
        q.end_after_start_or_null("t", df, "e", "s"), q.end_strictly_after_start("t", df, "e", "s"),
        q.relationships("t", df.withColumn("k", F.lit(2).cast("long")), "k", parent, "k"),
    ]).collect()}
    assert s[("not_null", "k")] == 1 and s[("unique", "k")] == 1
    assert s[("between_0_and_100", "pct")] == 2 and s[("non_negative", "pct")] == 1
    assert s[("accepted_values", "flag")] == 1
    assert s[("end_after_start_or_null", "e")] == 0 and s[("end_strictly_after_start", "e")] == 1
    assert s[("relationships", "k")] == 3


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "row_key" in df.columns
    from practica.oracle.queries_sql import oracle_queries
    from practica.plans.queries import spark_queries
    assert set(spark_queries()) == set(oracle_queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_source_registry_round_trip(spark, tmp_path):
    from practica.operators.staging import stage_all
    from practica.sources.schemas import read_sources
    from tests import tiny
    src = tiny.sources(spark)
    for name, df in src.items():
        df.write.parquet(str(tmp_path / name))
    back = read_sources(spark, str(tmp_path))
    assert back.project.count() == 4 and back.deliverable.schema == src.deliverable.schema
    assert stage_all(back).time_entry.count() == 6
