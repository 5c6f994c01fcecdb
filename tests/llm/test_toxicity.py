import math
import os
import random
import zlib

import numpy as np
import pytest

from practica.llm import toxicity

from .conftest import SCHEMA, rows, words

BAD = ["dolt", "wretched", "vermin", "rotten"]


def corpus(spark, n=900):
    rng = random.Random(4)
    texts, labels = [], []
    for i in range(n):
        w = words(rng, 120, 3000).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(6):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        texts.append(" ".join(w))
        labels.append((i, 1, int(toxic)))
    return (spark.createDataFrame(rows(texts), SCHEMA),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    got = toxicity.score_documents(docs, toxicity.train(docs, labels)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum(r.predicted == int(r.doc_id % 4 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_a_large_sample_keeps_the_toxic_words_of_few_texts(spark):
    rng = random.Random(8)
    rare = [f"boco{c}{d}" for c in "abcdefgh" for d in "abcdefghijklmnop"]
    texts = [(words(rng, 20, 300) + " " + rng.choice(BAD), 1, False) for _ in range(2250)]
    texts = [(t + " " + rare[i // 10 % len(rare)] if i < 1280 else t, 1, False) for i, (t, _, _) in enumerate(texts)]
    texts += [(words(rng, 20, 300), 0, False) for _ in range(6750)]
    ordinary, toxic = toxicity.dictionaries(spark.createDataFrame(texts, "text string, toxic int, fit boolean"))
    assert all(f" {w} ".encode() in toxic for w in [*BAD, *rare])
    assert not any(w.encode() in ordinary for w in [*BAD, *rare])


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(spark, 300)
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.score_documents(docs, toxicity.train(docs, x)).collect()))
            for x in (labels, flipped))
    assert a == b


def test_odd_documents(spark, odd_docs, no_docs):
    docs, labels = corpus(spark, 300)
    model = toxicity.train(docs, labels.unionByName(
        spark.createDataFrame([(None, 1, 1), (3, None, None), (3, 1, 1)], labels.schema)))
    assert toxicity.score_documents(odd_docs, model).count() == odd_docs.count()
    kept = toxicity.drop_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert toxicity.score_documents(no_docs, model).count() == 0
    none = toxicity.train(docs, labels.filter("toxic = 0"))
    assert none is None and toxicity.score_documents(odd_docs, none).filter("score <> 0").count() == 0
    assert toxicity.train(no_docs, labels) is None


def test_score_equals_compressing_each_window(spark):
    import zstandard
    docs, labels = corpus(spark, 300)
    (ordinary, toxic), weights, intercept = model = toxicity.train(docs, labels)

    def length(window, dictionary):
        held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=held, write_content_size=False).compress(window))
    for r in toxicity.score_documents(docs.limit(20), model).join(docs.select("doc_id", "text"), "doc_id").collect():
        data = f" {' '.join(r.text.lower().split())} ".encode()
        diff = sorted((length(w, ordinary) - length(w, toxic) for w in (data[i:i + 80] for i in range(0, len(data), 64))),
                      reverse=True)
        n = len(diff)
        inputs = [sum(min(max(d, -6), 12) == k for d in diff) / n for k in range(-6, 13)] + [sum(diff) / n]
        inputs += [sum(diff[:k]) / len(diff[:k]) for k in (1, 2, 4)]
        inputs += [math.log(1 + sum(d >= k for d in diff)) for k in (2, 3, 4, 5, 6, 8)] + [math.log(n)]
        assert r.score == pytest.approx(1 / (1 + math.exp(-(np.dot(inputs, weights) + intercept))), abs=1e-9)


def test_chance_words_of_near_copies_are_left_out(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("aeiounrstlm") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]

    def some(rng):
        return [vocabulary[int(3000 * rng.random() ** 2)] for _ in range(60)]
    texts = []
    for i in range(2000):
        toxic = i % 5 == 0
        w = some(random.Random(i // 200)) if toxic and i % 20 == 0 else some(rng)
        texts.append((" ".join(w + ([rng.choice(BAD) for _ in range(4)] if toxic else [])), i))
    docs = spark.createDataFrame(rows([t for t, _ in texts]), SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(2000)], "doc_id long, quality int, toxic int")
    got = [r for r in toxicity.score_documents(docs, toxicity.train(docs, labels)).collect() if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in got) >= 0.95 * len(got)


SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_held_out_quality_on_the_test_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    some = docs.join(labels.filter(toxicity.held_out(labels["doc_id"])).select("doc_id", "toxic"), "doc_id")
    got = toxicity.score_documents(some.drop("toxic"), model).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    yes, no = ([r for r in got if r.toxic == k] for k in (1, 0))
    found = [r for r in got if r.predicted]
    above = np.mean([(a.score > b.score) + 0.5 * (a.score == b.score) for a in yes for b in no])
    assert above >= 0.88
    assert sum(r.predicted for r in yes) >= 0.60 * len(yes)
    assert sum(r.toxic for r in found) >= 0.80 * len(found)
