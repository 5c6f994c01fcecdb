"""How often the facts move rows (planning only, sf0.001, no broadcasts)."""

import pytest

SF = "/root/testdata/sf0.001"
KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k) for k in KEYS}
    for k in KEYS:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def count(spark, query, node, holding=""):
    from practica.plans.queries import spark_queries
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = spark_queries()[query](spark, SF)._jdf.queryExecution().explainString(mode)
    return sum(f") {node}" in n.split("\n")[0] and holding in n for n in plan.split("\n\n"))


@pytest.mark.parametrize("query", ["fact_project", "fact_project_fraction"])
def test_project_fact_moves_rows_seldom(shuffled, query):
    """61 exchanges and 13 scans of orders before: entries were reduced before and
    after they met their project, projects sorted for every measure."""
    assert count(shuffled, query, "Exchange") <= 45
    assert count(shuffled, query, "Scan parquet", "/orders.parquet") <= 9


def test_deliverables_meet_projects_where_they_are_made(shuffled):
    assert count(shuffled, "dim_deliverable", "Exchange") <= 18


def test_latest_month_of_undated_and_repeated_projects(spark):
    """One undated row hides the others' months (or not, with latest_nulls last)."""
    import datetime as dt

    from practica.operators import measures as m
    from practica.operators.staging import stage_all
    from practica.semantics import Semantics
    from tests import tiny
    rows = tiny.rows()
    rows["project"] = rows["project"] + [r[:15] + (None,) for r in rows["project"] if r[0] == 100]
    rows["project"] += [r[:15] + ("2024-01-02 00:00:00",) for r in rows["project"] if r[0] == 101]
    st = stage_all(tiny.sources(spark, rows))

    def of(sem, since=None):
        src = st.project if since is None else st.project.filter(f"last_update > timestamp_ntz'{since}'")
        got = m.with_history(m.latest_project(src, sem), st, sem, since).collect()
        return {r.project_id: (r.hours_spent, r.project_expenses_per_month, r.total_tm_consultant_revenue) for r in got}
    first, last = of(Semantics()), of(Semantics(latest_nulls="last"))
    assert first[100][:2] == (None, None) and first[100][2] == tiny.D("975.0000")   # 6.5 h at 150
    assert last[100][:2] == (tiny.D("4.50"), tiny.D("20.0000"))
    assert first[101][:2] == last[101][:2] == (tiny.D("4.00"), tiny.D("7.5000"))
    assert set(of(Semantics(), dt.datetime(2024, 2, 1))) == {100}


def test_entries_move_to_their_project_once(shuffled):
    """12 exchanges before: entries were also reduced by deliverable and month."""
    assert count(shuffled, "consultant_revenue_month", "Exchange") <= 11


def test_day_key_is_the_timestamp_key_of_a_date(spark):
    from pyspark.sql import functions as F

    from practica.functions import keys
    days = spark.sql("select explode(array(date'2024-02-29', date'1899-12-31', cast(null as date))) as d")
    assert all(r.a == r.b for r in days.select(keys.day_to_key("d").alias("a"), keys.ts_to_key(F.col("d")).alias("b")).collect())


def test_checks_call_no_function_of_each_entry(spark):
    """Entries were filtered by a lambda, interpreted for each of a row's entries."""
    from practica.operators import quality as q
    df = spark.sql("select explode(array(1, 1, 2, null)) as k").withColumnRenamed("k", "key")
    summary = q.summarize([q.unique("r", df, "key"), q.not_null("r", df, "key"), q.accepted_values("r", df, "key", [1])])
    assert "lambdafunction" not in summary._jdf.queryExecution().toString()
    assert {r.check: r.failures for r in summary.collect()} == {"unique": 1, "not_null": 1, "accepted_values": 1}


def test_reductions_read_numbers_with_late_events(spark, tmp_path, monkeypatch):
    """A second run read all events once more to see whether any has no number,
    and cut the file's path out of each stored row."""
    import datetime as dt

    from practica.operators import parts, reductions
    r = reductions.Reduction(("k",), "day", "number", "value", "k")

    def events(*rows):
        return spark.createDataFrame(rows, "k long, day date, number long, value long")
    first = [(1, dt.date(2024, m, 5), m, 10) for m in range(1, 7)]
    monkeypatch.setattr(parts.F, "regexp_extract", None)
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", None)
    reductions.maintain(spark, events(*first), r, f"{tmp_path}/a")
    late = [*first, (1, dt.date(2024, 1, 9), 7, 5)]
    got = reductions.maintain(spark, events(*late), r, f"{tmp_path}/a").frame().collect()
    assert sorted((x.day.month, x.value) for x in got) == [(1, 15), *[(m, 10) for m in range(2, 7)]]
    unnumbered = [*late, (1, dt.date(2024, 2, 9), None, 1)]       # a full run
    got = reductions.maintain(spark, events(*unnumbered), r, f"{tmp_path}/a").frame().collect()
    assert sorted((x.day.month, x.value) for x in got) == [(1, 15), (2, 11), *[(m, 10) for m in range(3, 7)]]


def test_keys_of_deliverables_are_dealt_by_the_splits_of_their_scan(spark, tmp_path):
    """Adaptive execution joined them into tasks of millions of keys: as many
    parts as cores, whatever the input."""
    from practica.plans.queries import Context
    from practica.sources import driver_tables as d
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    few, many = d.deliverable(lineitem, keyed=True), d.deliverable(lineitem.union(lineitem), keyed=True)
    splits = lineitem.rdd.getNumPartitions()
    assert few.rdd.getNumPartitions() == 8 * splits and many.rdd.getNumPartitions() == 16 * splits
    assert few.exceptAll(d.deliverable(lineitem)).isEmpty()
    assert Context(spark, SF).marts.deliverable.rdd.getNumPartitions() == 8 * splits


def test_keys_of_versions_are_made_where_they_are_joined(shuffled):
    """Each version moved to its project with the 32 characters of its key."""
    for query in ("fact_project_all_versions", "fact_project"):
        assert count(shuffled, query, "Exchange", "project_key") == 0


def test_entries_are_grouped_by_project_once(shuffled):
    """45 exchanges before, one of entries by project, month and consultant."""
    assert count(shuffled, "fact_project", "Exchange", "_now") <= 1
    assert count(shuffled, "fact_project", "Exchange") <= 44


def test_both_rates_come_from_one_reading(shuffled):
    from practica.plans.queries import spark_queries
    rates = spark_queries()["staging_billing_rate"](shuffled, SF)
    assert rates._jdf.queryExecution().toString().count("orders.parquet") == 1


def test_stored_projects_come_from_one_reading(shuffled, monkeypatch):
    """Early and January projects were read apart, in each use of the projects."""
    from practica.plans import queries as pq
    seen = []
    monkeypatch.setattr(pq, "_merged", lambda c, builder, before, now, *a, **k: seen.append(before.project) or before.project)
    stored = pq.spark_queries()["cutoff_last_update"](shuffled, SF)
    assert len(seen) == 1 and stored._jdf.queryExecution().toString().count("orders.parquet") <= 1
    p = pq.Context(shuffled, SF).st.project
    assert stored.count() == p.filter("last_update is null or last_update < timestamp_ntz'1999-01-01' or "
                                      "(last_update < timestamp_ntz'1999-02-01' and project_id % 2 = 0)").count()


def test_checks_move_a_key_once_as_bytes(spark):
    """A key moved as 32 characters, once for every check that asks for it."""
    from pyspark.sql import functions as F

    from practica.operators import quality as q
    parent = spark.range(3).select(F.md5(F.col("id").cast("string")).alias("pk"))
    child = parent.select(F.col("pk").alias("ck")).union(spark.sql(
        "select explode(array(md5('7'), upper(md5('1')), '', null, md5('7')))"))
    checks = [q.unique("parent", parent, "pk"), q.relationships("child", child, "ck", parent, "pk"),
              q.unique("child", child, "ck"), q.relationships("back", parent, "pk", child, "ck"),
              q.not_null("child", child, "ck"), q.unique("other", spark.range(1), "id")]
    summary = q.summarize(checks)
    found = {(r.check, r.relation): r.failures for r in summary.collect()}
    assert found == {("unique", "parent"): 0, ("relationships", "child"): 4, ("unique", "child"): 1,
                     ("relationships", "back"): 0, ("not_null", "child"): 1, ("unique", "other"): 0}
    assert all(found[ck.name, ck.relation] == (ck.failures().count() if ck.name != "relationships" else
               ck.failures().agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]) for ck in checks)
    exchanged = [p for p in summary._jdf.queryExecution().sparkPlan().toString().split("\n") if "Generate" in p]
    assert sum(p.count("unhex(") for p in exchanged) == 3      # parent.pk, child.ck and other.id


def test_unequal_keys_are_unequal_bytes(spark):
    from pyspark.sql import functions as F

    from practica.operators.quality import packed
    texts = ["0" * 32, "a" * 32, "A" * 32, "a" * 32 + "\n", "a" * 31, "", "\0", "1", "01", "é"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(packed(F.col("t")).alias("p")).collect()
    assert len({bytes(r.p) for r in got}) == len(texts) and len(got[0].p) == 16


def test_bridge_joins_versions_by_their_start(shuffled):
    """Each deliverable moved with the 32 characters of its key."""
    assert count(shuffled, "hr_deliverable_bridge", "Exchange", "deliverable_key") == 0


def test_business_measures_meet_in_one_grouping(shuffled):
    """42 exchanges before: each measure was reduced to (client, unit, month) before
    all were, entries moved by project twice; clients' keys moved as text."""
    assert count(shuffled, "fact_business_dev", "Exchange") <= 35
    assert count(shuffled, "fact_business_dev", "Exchange", "client_key") == 0
    assert count(shuffled, "consultant_revenue_month", "Exchange") <= 9


def test_stored_keys_move_as_bytes_and_read_as_text(spark, tmp_path, monkeypatch):
    import datetime as dt

    from practica.operators import parts
    rows = [(k, k, i, dt.date(2024, 1 + i % 2, 1)) for i, k in enumerate(["a" * 32, "A" * 32, "", None, "x\0", "é|"])]
    df = spark.createDataFrame(rows, "row_key string, note string, n int, date date")
    moved = []
    real = parts.dealt_by
    monkeypatch.setattr(parts, "dealt_by", lambda r, *by: moved.append(dict(r.dtypes)) or real(r, *by))
    stored = parts.write_parts(df, f"{tmp_path}/t", ["date"])
    assert moved[0]["row_key"] == "binary" and moved[0]["note"] == "string"
    assert sorted(map(tuple, stored.frame().collect()), key=lambda r: r[2]) == rows
    parts.write_parts(df, f"{tmp_path}/t", ["date"], dealt=True)
    assert len(moved) == 1      # dealt before its keys were made


def test_projects_do_not_move_by_client_with_their_measures(shuffled):
    """All that was known of a project moved to its client's key, and to its month
    with the characters of four keys."""
    assert count(shuffled, "fact_project", "Exchange", "client_key") == 0
    assert count(shuffled, "fact_project", "Exchange") <= 43


def test_each_version_of_a_client_gives_its_key(spark):
    import datetime as dt

    from practica.operators.staging import stage_all
    from practica.plans import facts
    from practica.plans.marts import build_marts, snapshot_all
    from practica.semantics import Semantics
    from pyspark.sql import functions as F
    from tests import tiny
    st, sem = stage_all(tiny.sources(spark)), Semantics(dim_version="all")
    h1 = snapshot_all(st, dt.datetime(2024, 1, 1))
    again = st.replace(client=st.client.filter("client_id <> 11").withColumn(
        "phone_number", F.when(F.col("client_id") == 10, "555").otherwise(F.col("phone_number"))))
    marts = build_marts(snapshot_all(again, dt.datetime(2024, 6, 30), h1), sem)
    marts = marts.replace(client=marts.client.filter("client_id <> 12"))
    keys = {}
    for r in marts.client.collect():
        keys.setdefault(r.client_id, set()).add(r.client_key)
    assert len(keys[10]) == 2
    got = {}
    for r in facts.project_fact(st, marts, sem).collect():
        got.setdefault(r.project_id, set()).add(r.client_key)
    assert got == {100: keys[10], 101: keys[11], 102: {None}, 103: keys[10]}
