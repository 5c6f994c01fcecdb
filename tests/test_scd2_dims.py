import datetime as dt

from pyspark.sql import functions as F

from practica.operators import dims
from practica.operators.scd2 import SNAPSHOTS, scd2_snapshot
from practica.semantics import Semantics

T1, T2, T3 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
SCHEMA = "client_id long, client_name string, phone_number string, email string"


def _hist(df):
    return {(r.client_id, r.valid_from): r for r in df.collect()}


def test_check_strategy_two_runs(spark):
    spec = SNAPSHOTS["client"]
    run1 = spark.createDataFrame([(1, "A", "555-1", "a@x.io"), (2, "B", "555-2", None),
                                  (3, "C", "555-3", "c@x.io"), (4, "D", "555-4", "d@x.io")], SCHEMA)
    run2 = spark.createDataFrame([(1, "A", "555-9", "a@x.io"),     # changed phone
                                  (2, "B", "555-2", "b@x.io"),     # NULL -> value
                                  (3, "C", "555-3", "c@x.io"),     # unchanged
                                  (5, "E", "555-5", "e@x.io")],    # new; 4 missing
                                 SCHEMA)
    h1 = scd2_snapshot(run1, spec, T1)
    h2 = _hist(scd2_snapshot(run2, spec, T2, h1))
    assert h2[(1, T1)].valid_to == T2 and h2[(1, T2)].phone_number == "555-9"
    assert h2[(1, T2)].valid_to is None
    assert h2[(2, T1)].valid_to == T2 and h2[(2, T2)].email == "b@x.io"
    assert h2[(3, T1)].valid_to is None and (3, T2) not in h2
    assert h2[(4, T1)].valid_to is None                    # missing keys stay open
    assert h2[(5, T2)].valid_to is None and (5, T1) not in h2
    assert len(h2) == 7


def test_snapshot_is_idempotent_and_intervals_disjoint(spark):
    spec = SNAPSHOTS["client"]
    run1 = spark.createDataFrame([(1, "A", "555-1", "a@x.io"), (2, "B", None, None)], SCHEMA)
    run2 = spark.createDataFrame([(1, "A", "555-7", "a@x.io"), (2, "B", None, None)], SCHEMA)
    h2 = scd2_snapshot(run2, spec, T2, scd2_snapshot(run1, spec, T1))
    h3 = scd2_snapshot(run2, spec, T3, h2)       # same input again: nothing changes
    assert sorted(map(tuple, h2.collect())) == sorted(map(tuple, h3.collect()))
    open_per_key = h3.filter(F.col("valid_to").isNull()).groupBy("client_id").count()
    assert open_per_key.filter(F.col("count") > 1).count() == 0
    rows = sorted(h3.collect(), key=lambda r: (r.client_id, r.valid_from))
    for a, b in zip(rows, rows[1:]):
        if a.client_id == b.client_id:
            assert a.valid_to is not None and a.valid_to <= b.valid_from


def test_interval_intersection_dims(spark):
    dh = spark.createDataFrame(
        [(1, 10, "D1", dt.date(2024, 1, 1), T1, T3), (2, 10, "D2", None, T2, None), (3, 99, "D3", None, T1, None)],
        "deliverable_id long, project_id long, name string, due_date date, "
        "valid_from timestamp_ntz, valid_to timestamp_ntz")
    ph = spark.createDataFrame(
        [(10, "P", "Fixed", T1, T2), (10, "P2", "Fixed", T2, None)],
        "project_id long, project_name string, project_type string, "
        "valid_from timestamp_ntz, valid_to timestamp_ntz")
    overlap = dims.deliverable_dim(dh, ph, Semantics())
    got = sorted((r.deliverable_id, r.projectname, r.valid_from, r.valid_to) for r in overlap.collect())
    assert got == [(1, "P", T1, T2), (1, "P2", T2, T3), (2, "P2", T2, None), (3, None, T1, None)]
    every = dims.deliverable_dim(dh, ph, Semantics(overlap_only=False))
    assert every.count() == 5  # deliverable 2 also meets the project version that ended before it
    keys = [r.deliverable_key for r in overlap.collect()]
    assert len(set(keys)) == len(keys)
