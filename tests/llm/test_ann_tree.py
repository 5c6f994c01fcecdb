import numpy as np
from pyspark.sql import functions as F

from practica.llm import ann_tree

SCHEMA = "vec_id long, embedding array<float>, label int, leaf string, score string"


def table(spark, n=3000, d=16):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, d))
    x = (centers[rng.integers(0, 30, n)] + 0.3 * rng.normal(size=(n, d))).astype(np.float32)
    x[100:160] = x[100]                                   # ties
    data = [(i, v.tolist(), 0, "x", "y") for i, v in enumerate(x)]
    data += data[40:45]
    data += [(n, None, 0, "", ""), (n + 20, [0.0] * d, 0, "", ""), (n + 40, [float("nan")] * d, 0, "", ""),
             (n + 60, [None] + [1.0] * (d - 1), 0, "", ""), (n + 80, [float("inf")] * d, 0, "", ""),
             (n + 100, [1.0], 0, "", ""), (None, [1.0] * d, 0, "", "")]
    return spark.createDataFrame(data, SCHEMA), x.astype(np.float64)


def exact(x, q, k=20):
    s = (x * x[q]).sum(axis=1)
    order = [i for i in np.lexsort((np.arange(len(x)), -s)) if i != q][:k]
    return [(i, s[i]) for i in order]


def test_recall_scores_and_order(spark, monkeypatch):
    df, x = table(spark)
    for chunk in (2048, 16):
        monkeypatch.setattr(ann_tree, "CHUNK_ROWS", chunk)
        monkeypatch.setattr(ann_tree, "CHUNK_QUERIES", chunk)
        got = {}
        for r in ann_tree.nearest(df, F.col("vec_id") % 20 == 0).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert sorted(got) == list(range(0, 3000, 20))
        hits = 0
        for q, found in got.items():
            found.sort()
            assert [n for n, _, _ in found] == list(range(1, 21))
            assert found == sorted(found, key=lambda f: (-f[2], f[1])) and q not in [v for _, v, _ in found]
            assert all(s == (x[v] * x[q]).sum() for _, v, s in found)
            hits += len({v for _, v, _ in found} & {v for v, _ in exact(x, q)})
        assert hits >= 0.9 * 20 * len(got)


def test_all_leaves_visited_is_exact(spark):
    df, x = table(spark, 500)
    got = {}
    for r in ann_tree.nearest(df, F.col("vec_id") % 20 == 0, recall=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: exact(x, q) for q in range(0, 500, 20)}


def test_few_rows_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0, "", ""), (1, [1.0, 1.0], 0, "", "")], SCHEMA)
    assert [tuple(r) for r in ann_tree.nearest(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1.0)]
    assert ann_tree.nearest(df.filter("false"), F.col("vec_id") == 0).count() == 0
    assert ann_tree.nearest(df, F.col("vec_id") == 7).count() == 0
