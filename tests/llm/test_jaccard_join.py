import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from practica.llm import jaccard_join as join

from .conftest import SCHEMA, rows, words


def brute(data):
    """(links, class) by comparing every pair."""
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets, links, root = [shingles(t) for _, t in data], Counter(), list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(data)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if (data[i][1] or "") == (data[j][1] or "") or (a and len(a & b) >= 0.8 * len(a | b)):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(data):
        if doc is not None:
            r = find(i)
            low[r] = min(doc, low.get(r, doc))
    return sorted(((d is None, d or 0), links[i], low.get(find(i))) for i, (d, _) in enumerate(data))


def found(df):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.n_links, r.class_id) for r in df.collect())


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def near_docs(spark, copies=40):
    rng = random.Random(5)
    texts = [words(rng, 200, 5000) for _ in range(30)]
    for t in texts[:12]:
        texts += [edited(rng, t, n) for n in (1, 2, 4, 6, 9)]
    texts += [edited(rng, texts[20], rng.randrange(1, 4)) for _ in range(copies)] + texts[:4] * 3
    return spark.createDataFrame(rows(texts), SCHEMA)


def test_links_and_classes_against_all_pairs(spark, odd_docs):
    for docs in (odd_docs, near_docs(spark)):
        data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert found(join.link_documents(docs)) == brute(data)


def test_tiles_of_a_large_node_give_the_same(spark, monkeypatch):
    docs = near_docs(spark)
    whole = found(join.link_documents(docs))
    assert found(join.link_documents(docs, tile=7)) == whole
    monkeypatch.setattr(join, "TILE_SHINGLES", 3000)
    assert found(join.link_documents(docs)) == whole


def test_intersections_by_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(23)]
    values, offsets = np.concatenate(sets), np.cumsum([0, *map(len, sets)])
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    for block in (1, 7, 512):
        monkeypatch.setattr(join, "BLOCK", block)
        assert (np.concatenate([rows for _, rows in join.common_shingles(values, offsets)]) == want).all()


def levels(spark, texts, **options):
    docs = spark.createDataFrame(rows(texts), SCHEMA).select("text", F.md5("text").alias("digest"))
    classes = join.sign(docs.withColumn("doc_id", F.lit(1).cast("long")).select("doc_id", "digest", "text")).groupBy("digest").agg(
        F.count("*").alias("copies"), F.first("signature").alias("signature"), F.first("size").alias("size"))
    links, found = join.forest_links(docs, classes, **options)
    return links, found


def test_prefixes_shorten_only_as_far_as_the_links_found_ask_for(spark):
    rng = random.Random(2)
    base = [words(rng, 400, 9000) for _ in range(60)]
    for edits, recall in ((1, 0.9999), (8, 0.9999)):
        _, found = levels(spark, base + [edited(rng, t, edits) for t in base], recall=recall)
        depths = [d for d, _, _ in found]
        assert depths == list(range(join.DEPTH, join.DEPTH - len(depths), -1))
        assert found[-1][2] <= 1 - recall or depths[-1] == join.least_depth(recall=recall)
        assert all(share > 1 - recall for _, _, share in found[:-1])
        assert sum(n for _, n, _ in found) >= (60 if edits == 1 else 1)
    close = np.eye(1, join.BINS, join.BINS - 2)[0] * 1e6        # a million links at 0.98, and one at 0.8
    assert join.missed_share(close, 6) < 1e-9 < join.missed_share(close * 0, 6)
    assert join.least_depth() == 4 and join.least_depth(1.0) == join.DEPTH


def test_each_pair_is_verified_in_one_node_only():
    rng = np.random.default_rng(4)
    sig = rng.integers(0, 3, (40, join.TREES * join.DEPTH)).astype(np.uint16)
    sig[20:] = np.where(rng.random(sig[20:].shape) < 0.9, sig[:20], sig[20:])
    h, times = join.prefixes(sig), np.zeros((40, 40), int)
    for depth in range(join.DEPTH, 3, -1):
        for tree in range(join.TREES):
            times += join.first_meetings(h, tree, depth)
    meets = (h[:, None, :, 3] == h[None, :, :, 3]).any(axis=2) & ~np.eye(40, dtype=bool)
    assert (times == meets).all()


def test_no_link_of_60000_pairs_at_the_threshold_is_lost():
    rng = np.random.default_rng(7)
    lost, n, depth = 0, 2000, join.least_depth()
    for _ in range(30):
        # sets of 45 shingles, 40 of them shared: similarity 40 / 50
        shared = rng.integers(0, 1 << 63, (n, 40), dtype=np.uint64)
        pair = [join.prefixes(join.signatures(np.concatenate(
            [shared, rng.integers(0, 1 << 63, (n, 5), dtype=np.uint64)], axis=1).ravel(), np.full(n, 45)))[:, :, depth - 1]
            for _ in range(2)]
        lost += int((~(pair[0] == pair[1]).any(axis=1)).sum())
    assert lost == 0


def test_one_of_each_class_stays(spark, odd_docs):
    for docs in (near_docs(spark), odd_docs):
        kept = join.keep_one(docs)
        assert kept.columns == docs.columns
        data = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        classes = {c for _, _, c in brute(data) if c is not None}
        assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(classes)


def test_chain_becomes_one_component(spark):
    n = 40
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(n)], "u string, v string")
    roots = {r.node: r.root for r in join.components(edges).collect()}
    assert roots == {f"{i:03d}": "000" for i in range(n + 1)}


def test_empty(no_docs):
    assert join.link_documents(no_docs).count() == 0 and join.keep_one(no_docs).count() == 0
