"""Plan-shape guards for every query of the marts (planning only, sf0.001).

At 100 TB the things that hurt are pair-generating joins, row-at-a-time
Python and unpruned scans; these assertions keep them out of every plan.
"""

import re

import pytest

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
WIDE_TABLES = {"lineitem": 11, "orders": 6}


@pytest.fixture(scope="module")
def plans(spark):
    from practica.plans.queries import spark_queries
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    out = {}
    for name, fn in spark_queries().items():
        df = fn(spark, SF)
        out[name] = df._jdf.queryExecution().explainString(mode)
    return out


def test_no_pair_joins_or_python(plans):
    bad = {n: [f for f in FORBIDDEN if f in p] for n, p in plans.items()}
    assert {n: f for n, f in bad.items() if f} == {}


def test_scans_are_pruned(plans):
    """No query reads every column of the wide driver tables."""
    seen = 0
    for name, plan in plans.items():
        for node in plan.split("\n\n"):
            if "Scan parquet" not in node:
                continue
            out = re.search(r"Output \[(\d+)\]", node)
            for table, ncols in WIDE_TABLES.items():
                if f"/{table}.parquet" in node:
                    seen += 1
                    assert int(out.group(1)) < ncols, (name, table)
    assert seen > 0


def test_merge_measures_share_one_aggregate(plans):
    """Measures of one grain are merged by a single union + aggregate, not a
    chain of outer joins: the finance fact has no sort-merge outer join on
    (unit, month)."""
    plan = plans["fact_finance"]
    assert "Union" in plan
    assert "FullOuter" not in plan


def scans(plan, table):
    return sum("Scan parquet" in node and f"/{table}.parquet" in node for node in plan.split("\n\n"))


def test_large_inputs_are_scanned_few_times(plans):
    """Several grains come from one scan: entries, expenses, deliverables twice."""
    assert scans(plans["fact_finance"], "lineitem") <= 4
    assert scans(plans["fact_finance_any_anchor"], "lineitem") <= 4
    assert scans(plans["fact_project"], "lineitem") <= 4


def test_all_data_tests_of_a_relation_share_one_scan(spark, tmp_path):
    from practica.operators import quality as q
    for name in ("child", "parent"):
        spark.range(5).selectExpr("id AS k", "id % 2 AS flag", "id AS other").write.parquet(f"{tmp_path}/{name}.parquet")
    child, parent = (spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("child", "parent"))
    checks = [q.unique("child", child, "k"), q.unique("child", child, "flag"), q.not_null("child", child, "k"),
              q.relationships("child", child, "k", parent, "k"), q.relationships("child", child, "other", parent, "flag"),
              q.unique("parent", parent, "k")]
    df = q.summarize(checks)
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert scans(plan, "child") == scans(plan, "parent") == 1
    got = {(r.check, r.relation, r.column_name): r.failures for r in df.collect()}
    assert got == {("unique", "child", "k"): 0, ("unique", "child", "flag"): 2, ("not_null", "child", "k"): 0,
                   ("relationships", "child", "k"): 0, ("relationships", "child", "other"): 3, ("unique", "parent", "k"): 0}
    assert checks[1].failures().count() == 2 and checks[4].failures().count() == 3
