"""Stored tables made of parts: merges, histories, reductions, cutoffs, retention."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from practica.operators import incremental, parts
from practica.operators.incremental import incremental_refresh, last_update_watermark, month_cutoff
from practica.operators.reductions import REDUCTIONS, changes, lookback, maintain, reduce
from practica.operators.scd2 import SNAPSHOTS, read_history, scd2_snapshot, snapshot_parts
from practica.plans import build, facts
from practica.plans.build import latest_month, run_build
from practica.semantics import Semantics
from tests import tiny
from tests.literal import rows_of

FACT = "row_key string, date date, amount int, note string"


def month(m):
    return dt.date(2023 + m // 12, m % 12 + 1, 1)


def fact(spark, months, amount=1, schema=FACT):
    return spark.createDataFrame([(f"{u}-{m}", month(m), amount * m, "x") for m in months for u in "ab"], schema)


def files_of(stored):
    return {f: sorted(os.listdir(f"{stored.root}/{p['path']}")) for f, p in stored.parts.items()}


def jobs_of(spark, call):
    """(result, ids of the Spark jobs that the call ran)."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return call(), spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_merge_writes_only_the_months_of_its_batch(spark, tmp_path):
    root = str(tmp_path / "fact")
    first = parts.write_parts(fact(spark, range(12)), root, ["date"])
    files = files_of(first)
    batch = spark.createDataFrame([("a-11", month(11), 99, "y"), ("c-11", month(11), 1, "y"), ("a-12", month(12), 5, "y")], FACT)
    second = parts.merge_into(first, batch, root, "row_key", ["date"])
    assert second.version == 2 and len(second.parts) == 13
    for m in range(11):     # carried: the same folder, of the first version, with the same files
        folder = f"date={month(m)}"
        assert second.parts[folder] == first.parts[folder] and second.parts[folder]["path"].startswith("v=1/")
    assert files_of(first) == files
    assert {x for x in os.listdir(f"{root}/v=2") if "=" in x} == {f"date={month(11)}", f"date={month(12)}"}
    got = {r.row_key: r.amount for r in second.frame().collect()}
    want = {r.row_key: r.amount for r in fact(spark, range(12)).collect()} | {"a-11": 99, "c-11": 1, "a-12": 5}
    assert got == want and second.frame().count() == len(want)
    # the read before the rewrite covers one month
    read = second.frame(second.folders(lambda v: v["date"] == month(11))).inputFiles()
    assert read and all(f"date={month(11)}/" in f for f in read)


def test_a_changed_schema_needs_no_rewrite(spark, tmp_path):
    root = str(tmp_path / "fact")
    first = parts.write_parts(fact(spark, range(3)), root, ["date"])
    batch = spark.createDataFrame([("a-2", month(2), 7, 0.5)], "row_key string, date date, amount int, share double")
    second = parts.merge_into(first, batch, root, "row_key", ["date"])
    assert second.parts[f"date={month(0)}"] == first.parts[f"date={month(0)}"]
    assert second.frame().columns == ["row_key", "date", "amount", "share"]
    assert {r.row_key: (r.amount, r.share) for r in second.frame().collect()} == {
        "a-0": (0, None), "b-0": (0, None), "a-1": (1, None), "b-1": (1, None), "a-2": (7, 0.5), "b-2": (2, None)}
    # another type of a column that both have: all is rewritten
    wide = spark.createDataFrame([("a-2", month(2), 1 << 40, 0.5)], "row_key string, date date, amount long, share double")
    third = parts.merge_into(second, wide, root, "row_key", ["date"])
    assert all(p["path"].startswith("v=3/") for p in third.parts.values()) and third.frame().count() == 6
    assert {r.amount for r in third.frame().collect()} == {0, 1, 2, 1 << 40}


def test_null_months_and_empty_batches(spark, tmp_path):
    root = str(tmp_path / "fact")
    rows = spark.createDataFrame([("n", None, 1, "x"), ("a", month(1), 2, "x")], FACT)
    first = parts.write_parts(rows, root, ["date"])
    assert first.bounds("date") == (month(1), month(1))
    second = parts.merge_into(first, rows.filter("date is null").withColumn("amount", F.lit(9)), root, "row_key", ["date"])
    assert {r.row_key: r.amount for r in second.frame().collect()} == {"n": 9, "a": 2}
    third = parts.merge_into(second, rows.limit(0), root, "row_key", ["date"])
    assert third.parts == second.parts and third.frame().count() == 2
    empty = parts.write_parts(rows.limit(0), str(tmp_path / "none"), ["date"])
    assert empty.bounds("date") == (None, None) and empty.frame().count() == 0 and empty.frame().schema == rows.schema
    assert month_cutoff(empty) is None
    with pytest.raises(ValueError, match="kept for the version"):
        parts.write_parts(rows.withColumnRenamed("note", "V"), str(tmp_path / "bad"), ["date"])


def test_a_run_that_dies_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path / "fact")
    first = parts.write_parts(fact(spark, range(2)), root, ["date"])
    os.makedirs(f"{root}/v=2/date={month(0)}")           # data, but no manifest
    assert parts.open_table(spark, root).version == first.version
    assert parts.write_parts(fact(spark, range(2)), root, ["date"]).version == 3


def test_cutoffs_come_from_the_manifest(spark, tmp_path):
    rows = spark.createDataFrame([("a", month(3), dt.datetime(2023, 4, 5, 6, 7, 8, 123456)), ("b", month(5), None)],
                                 "row_key string, date date, last_update timestamp_ntz")
    root = str(tmp_path / "fact")
    parts.write_parts(rows, root, ["date"], statistics=["last_update"])
    stored = parts.open_table(spark, root)
    found, jobs = jobs_of(spark, lambda: (month_cutoff(stored), last_update_watermark(stored)))
    assert found == (month(4), dt.datetime(2023, 4, 5, 6, 7, 8, 123456)) and list(jobs) == []
    assert found == (month_cutoff(rows), last_update_watermark(rows))
    _, jobs = jobs_of(spark, lambda: month_cutoff(rows))
    assert list(jobs)
    reduced = parts.write_parts(spark.createDataFrame([(month(m), m) for m in (1, 4, 9)], "expense_date date, x int"),
                                str(tmp_path / "reduced"), ["expense_date"])
    sem = Semantics(calendar_start=month(0), calendar_end=month(6))
    found, jobs = jobs_of(spark, lambda: latest_month(reduced, sem))
    assert found == month(4) and list(jobs) == []


@pytest.mark.parametrize("day", [dt.date(2024, 3, 31), dt.date(2024, 1, 1), dt.date(2023, 3, 29), dt.date(2024, 2, 29)])
def test_month_before_is_add_months(spark, day):
    assert incremental.month_before(day) == spark.range(1).select(F.add_months(F.lit(day), -1)).first()[0]


def clients(spark, rows):
    return spark.createDataFrame(rows, "client_id long, client_name string, phone_number string, email string")


def test_a_history_in_two_parts(spark, tmp_path):
    spec, root, rng = SNAPSHOTS["client"], str(tmp_path / "client"), random.Random(3)
    state = {i: f"555-{i}" for i in range(30)}
    history, before = None, None
    for run in range(1, 6):
        ts = dt.datetime(2024, run, 1)
        for i in rng.sample(sorted(state), 4):
            state[i] = f"555-{i}-{run}"
        state[100 + run] = "new"
        rows = clients(spark, [(i, "c", p, None) for i, p in state.items() if i % 7 or run % 2])
        history = spark.createDataFrame(scd2_snapshot(rows, spec, ts, history).collect(), "client_id long, client_name string, "
                                        "phone_number string, email string, valid_from timestamp_ntz, valid_to timestamp_ntz")
        stored = snapshot_parts(rows, spec, ts, root)
        assert rows_of(read_history(spark, root).collect()) == rows_of(history.collect())
        written = {f for f, p in stored.parts.items() if p["path"].startswith(f"v={run}/")}
        assert written <= {"part=open", f"part=closed-{run}"}
        if before:
            carried = {f: p for f, p in before.parts.items() if f != "part=open"}
            assert {f: stored.parts[f] for f in carried} == carried
        before = stored
    assert len(before.parts) == 5
    opened = before.frame(before.folders(lambda v: v["part"] == "open")).inputFiles()
    assert opened and all("/v=5/part=open/" in f for f in opened)
    with pytest.raises(ValueError, match="not later"):
        snapshot_parts(rows, spec, dt.datetime(2024, 5, 1), root)


EVENTS = "consultant_id long, deliverable_id long, record_id long, hours decimal(10,2), work_date date"


def events(spark, path, rows):
    spark.createDataFrame([(r[0], r[1], r[2], tiny.D(r[3]), r[4]) for r in rows], EVENTS).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_kept_reductions_read_what_changed(spark, tmp_path):
    r, root, rng = REDUCTIONS["time_entry"], str(tmp_path / "reduced"), random.Random(1)
    rows = [(rng.randrange(4), rng.randrange(5), i, f"{rng.randrange(900)}.25", month(rng.randrange(10)) + dt.timedelta(days=rng.randrange(28)))
            for i in range(400)] + [(1, 1, 400, "1.00", None)]

    def same(stored, now):
        assert rows_of(stored.frame().collect()) == rows_of(reduce(now, r).select(*stored.frame().columns).collect())
    first = maintain(spark, events(spark, f"{tmp_path}/e1", rows), r, root)
    same(first, spark.read.parquet(f"{tmp_path}/e1"))
    assert lookback(first, r) == month(8)
    # an edit within the lookback, a month's events gone from it, late events (one undated), a new month
    edited = [(*x[:3], "7.00", x[4]) if x[4] and x[4] >= month(9) else x for x in rows if not (x[4] and month(8) <= x[4] < month(9))]
    later = [(2, 2, 500, "3.50", month(2)), (3, 3, 501, "4.00", None), (1, 2, 502, "5.00", month(10)), (1, 2, 503, "6.00", month(2))]
    now = events(spark, f"{tmp_path}/e2", edited + later)
    second = maintain(spark, now, r, root)
    same(second, now)
    new = {f for f, p in second.parts.items() if p["path"].startswith("v=2/")}
    assert new == {f"work_date={month(m)}" for m in (2, 9, 10)} | {f"work_date={parts.NULL_FOLDER}"}
    assert f"work_date={month(8)}" not in second.parts and not os.path.exists(f"{root}/_late/1")
    # both scans of the events carry a test on the raw date
    for part in changes(now, r, month(9), 502):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "work_date" in plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    # events without a number: a full refresh, which also sees edits of old months
    unnumbered = [(*x[:2], None if i == 0 else x[2], "1.00", x[4]) for i, x in enumerate(edited + later)]
    for rows in (unnumbered, unnumbered[1:]):
        now = events(spark, f"{tmp_path}/e{len(rows)}", rows)
        same(maintain(spark, now, r, root), now)
    # edits of old months without a new number are left to a full refresh
    old = [(*x[:3], "2.00", x[4]) for x in unnumbered[1:]]
    now = events(spark, f"{tmp_path}/e9", old)
    same(maintain(spark, now, r, root, full=True), now)


def test_late_events_reach_the_facts_of_a_second_build(spark, tmp_path):
    """A scheduled build from kept reductions equals a full one."""
    sem, rows = Semantics(as_of=dt.date(2024, 6, 30)), tiny.rows()
    later = {**rows, "consultant_deliverable": rows["consultant_deliverable"] + [(500, 1001, 90, tiny.D("2.50"), dt.date(2024, 1, 11)),
                                                                                 (501, 1002, 91, tiny.D("1.00"), dt.date(2024, 4, 2))],
             "project_expense": rows["project_expense"] + [(90, 101, tiny.D("4.0000"), dt.date(2024, 1, 20), 1),
                                                           (91, 100, tiny.D("6.0000"), dt.date(2024, 3, 3), 0)]}
    kept, full = str(tmp_path / "kept"), str(tmp_path / "full")
    run_build(spark, tiny.sources(spark), dt.datetime(2024, 3, 1), sem, kept)
    run_build(spark, tiny.sources(spark, later), dt.datetime(2024, 4, 1), sem, kept)
    run_build(spark, tiny.sources(spark, later), dt.datetime(2024, 4, 1), sem, full)
    for name in REDUCTIONS:
        a, b = (incremental.read_current(spark, f"{r}/reduced/{name}") for r in (kept, full))
        assert rows_of(a.collect()) == rows_of(b.collect()), name
    # finance reads one month before the latest expense: January's late row is left out by the source's own rule
    a, b = ({r.date: r for r in incremental.read_current(spark, f"{x}/facts/finance").filter("unit_key is not null")
             .select("date", "unit_key", "direct_project_expenses").collect()} for x in (kept, full))
    assert {d for d in a} == {d for d in b}
    assert a[dt.date(2024, 3, 1)].direct_project_expenses == b[dt.date(2024, 3, 1)].direct_project_expenses


def test_folders_stay_constant_over_ten_refreshes(spark, tmp_path):
    root, counts = str(tmp_path / "fact"), []
    for run in range(10):
        incremental_refresh(spark, root, lambda target: fact(spark, [4, 5], run), "row_key", ["date"])
        parts.prune(spark, root, keep=2)
        counts.append(sum(len(d) for _, d, _ in os.walk(root)))
    assert len(set(counts[2:])) == 1 and incremental.list_versions(spark, root) == [9, 10]
    plain = str(tmp_path / "dim")
    for _ in range(5):
        incremental.write_version(fact(spark, [1]), plain)
        incremental.keep_last(spark, plain, keep=2)
    assert incremental.list_versions(spark, plain) == [4, 5]
    assert incremental.keep_last(spark, str(tmp_path / "nothing")) == []


def test_pruning_keeps_what_the_last_versions_carry(spark, tmp_path):
    root = str(tmp_path / "fact")
    stored = parts.write_parts(fact(spark, range(4)), root, ["date"])
    for run in range(2, 5):
        stored = parts.merge_into(stored, fact(spark, [3], run), root, "row_key", ["date"])
    gone = parts.prune(spark, root, keep=1)
    assert [g.rpartition("/v=")[2] for g in gone] == [f"1/date={month(3)}", "2", "3"]
    assert {r.row_key: r.amount for r in parts.open_table(spark, root).frame().collect()} == {
        f"{u}-{m}": m * (4 if m == 3 else 1) for m in range(4) for u in "ab"}


def test_a_lookback_reads_few_partitions(spark, tmp_path):
    stored = parts.write_parts(fact(spark, range(12)), str(tmp_path / "fact"), ["date"])
    plan = stored.frame().filter(F.col("date") >= F.lit(month(10)))._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert build.FACTS["hr_utilization"][2] == "snapshot_month" and build.FACTS["project"][2] == "date"


def test_the_calendar_of_a_build_comes_from_its_data(spark, tmp_path):
    """Later rows are kept by default; a stand-in date is counted, not followed."""
    rows = tiny.rows()
    rows["project_expense"] = rows["project_expense"] + [(99, 100, tiny.D("5.0000"), dt.date(2026, 3, 4), 1)]
    rows["project"] = [r if r[0] != 100 else (*r[:13], "9999-12-31", *r[14:]) for r in rows["project"]]
    st = build.stage_all(tiny.sources(spark, rows))
    assert build.calendar_of(st, dt.date(2024, 6, 30))[1] == dt.date(2026, 12, 31)
    run_build(spark, tiny.sources(spark, rows), dt.datetime(2024, 6, 30), root=str(tmp_path / "marts"))
    dates = {r.date for r in incremental.read_current(spark, f"{tmp_path}/marts/facts/finance").select("date").collect()}
    assert dt.date(2026, 3, 1) in dates
    sem = Semantics(calendar_start=dt.date(2023, 1, 1), calendar_end=dt.date(2026, 12, 31))
    assert build.outside_calendar(st, sem) == {"project.actual_end_date": 1}
    far = Semantics(calendar_start=dt.date(2023, 1, 1), calendar_end=dt.date(9999, 12, 31))
    assert far.month_bounds() == (dt.date(2023, 1, 1), dt.date(9999, 12, 31))
    marts = build.build_marts({n: read_history(spark, f"{tmp_path}/marts/snapshots/{n}") for n in SNAPSHOTS}, far)
    assert facts.finance_fact(st, marts, far).count() >= len(dates)


def test_updated_projects_read_a_small_share_of_files(spark, tmp_path):
    """I5 by key: ten of a thousand projects, each with five deliverables."""
    r = REDUCTIONS["time_entry"]
    rows = spark.range(60_000).select((F.col("id") % 7).alias("consultant_id"), (F.col("id") % 5000).alias("deliverable_id"),
                                      F.col("id").alias("record_id"), F.lit(1).cast("decimal(10,2)").alias("hours"),
                                      F.expr("date_add(DATE'2023-01-01', cast(id % 360 as int))").alias("work_date"))
    stored = parts.write_parts(reduce(rows, r), str(tmp_path / "reduced"), ["work_date"], cluster=r.cluster, file_rows=200)
    files = [f for p in stored.parts.values() for f in p["files"]]
    assert len(files) > 150 and all(low <= high for _, low, high in files)
    again = parts.open_table(spark, stored.root)
    wanted = [p * 5 + k for p in range(300, 310) for k in range(5)]
    read = again.frame(keys=wanted)
    assert 0 < len(read.inputFiles()) <= 0.1 * len(files)
    found, every = (df.filter(F.col("deliverable_id").isin(wanted)) for df in (read, again.frame()))
    assert rows_of(found.collect()) == rows_of(every.collect()) and every.count()
    assert again.frame(keys=[10**9]).count() == again.frame(keys=[]).count() == 0
    # a table with one file for each partition and NULL keys
    null = parts.write_parts(rows.limit(3).withColumn("deliverable_id", F.lit(None).cast("long")), str(tmp_path / "null"),
                             ["work_date"], cluster="deliverable_id")
    assert null.frame(keys=[1]).count() == 0 and null.frame().count() == 3


def test_a_build_reads_updated_projects_by_key(spark, tmp_path, monkeypatch):
    sem, rows, root = Semantics(as_of=dt.date(2024, 6, 30)), tiny.rows(), str(tmp_path / "marts")
    run_build(spark, tiny.sources(spark), dt.datetime(2024, 3, 1), sem, root)
    rows["project"] = [(*r[:14], tiny.D("75.00"), "2024-04-05 00:00:00") if r[0] == 101 else r for r in rows["project"]]
    asked = []
    frame = parts.Stored.frame
    monkeypatch.setattr(parts.Stored, "frame", lambda self, folders=None, keys=None: (
        asked.append((self.root.rpartition("/")[2], keys)) if keys is not None else None, frame(self, folders, keys))[1])
    run_build(spark, tiny.sources(spark, rows), dt.datetime(2024, 4, 6), sem, root)
    assert asked == [("time_entry", [1002]), ("project_expense", [101])]
    monkeypatch.undo()
    st = build.stage_all(tiny.sources(spark, rows))
    marts = build.build_marts({n: read_history(spark, f"{root}/snapshots/{n}") for n in SNAPSHOTS}, sem)
    want = facts.project_fact(st, marts, sem).filter("project_id = 101")
    got = incremental.read_current(spark, f"{root}/facts/project").filter("project_id = 101 and date = '2024-04-01'")
    assert rows_of(got.select(*want.columns).collect()) == rows_of(want.collect())
