import math
import re
from collections import Counter

import pytest

from practica.llm import lm_scoring as lm


def brute(data, target, vocabulary):
    """Scores by plain counting; the vocabulary is given."""
    tokens = [["<s>", *[w if w in vocabulary else "<unk>" for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]]
              for _, t in data]
    losses = []
    for rows in ([x for x, (i, _) in zip(tokens, data) if i in target], tokens):
        pair = Counter(p for x in rows for p in zip(x, x[1:]))
        context, word = Counter(), Counter()
        for (v, w), n in pair.items():
            context[v] += n
            word[w] += n
        n, size = sum(word.values()), len(vocabulary) + lm.FIRST

        def loss(v, w, pair=pair, context=context, word=word, n=n, size=size):
            return -math.log((pair[v, w] + lm.PRIOR * (word[w] + 1) / (n + size)) / (context[v] + lm.PRIOR))
        losses.append([sum(loss(*p) for p in zip(x, x[1:])) / max(1, len(x) - 1) for x in tokens])
    return losses


@pytest.mark.parametrize("head", [10**6, 50, 1])
def test_scores_against_plain_counting(spark, odd_docs, head):
    """The same whether all, some or one of the bigrams go to every task."""
    data = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    vocabulary = {w for _, t in data for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")}
    target = {i for i, _ in data if i is not None and i % 3 == 0}
    trusted = odd_docs.filter("doc_id % 3 = 0").select("doc_id")
    got = lm.score_documents(odd_docs, trusted, head_size=head).collect()
    want = sorted((i is None, i or 0, round(a, 4), round(b, 4)) for (i, _), a, b in
                  zip(data, *brute(data, target, vocabulary)))
    assert len(got) == len(data)
    for r, w in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0, round(r.loss_target, 4))), want):
        assert (r.doc_id or 0) == w[1]
        assert r.loss_target == pytest.approx(w[2], abs=2e-3) and r.loss_background == pytest.approx(w[3], abs=2e-3)
        assert r.score == r.loss_target - r.loss_background


def test_a_small_vocabulary_is_the_most_frequent_words(spark, odd_docs):
    rows = lm.with_trust(odd_docs, odd_docs.select("doc_id"), "doc_id", "text")
    assert lm.shared_vocabulary(rows, 5).size == 5 + lm.FIRST


def test_every_word_counts_however_many_there_are(spark, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 5000)
    data = [(i, " ".join(f"w{i}x{k}" for k in range(40)) + f" common w{i // 2}") for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    target = {i for i in range(300) if i % 3 == 0}
    vocabulary = {w for _, t in data for w in t.split()}
    assert len(vocabulary) > 12_000
    got = lm.score_documents(docs, docs.filter("doc_id % 3 = 0").select("doc_id"), head_size=1000).orderBy("doc_id")
    for r, a, b in zip(got.collect(), *brute(data, target, vocabulary)):
        assert r.loss_target == pytest.approx(a, abs=1e-4) and r.loss_background == pytest.approx(b, abs=1e-4)


def test_no_target_and_empty(odd_docs, no_docs):
    assert lm.score_documents(odd_docs, no_docs.select("doc_id")).filter("score <> 0").count() == 0
    assert lm.score_documents(no_docs, no_docs.select("doc_id")).count() == 0


def test_what_stands_once_is_implied_and_the_rest_is_asked_for(spark, odd_docs):
    from pyspark.sql import functions as F
    rows = lm.with_trust(odd_docs, odd_docs.select("doc_id").limit(20), "doc_id", "text")
    bits = lm.bucket_bits(rows, "text", lm.BUCKET_BYTES)
    table = lm.key_table(lm.count_keys(rows, lm.Vocabulary(), bits))
    assert all((lm.unpack(r["n"]) > 1).all() for r in table.collect())
    sent, whole, _ = lm.broadcast_head(table, 10, None)
    blocks = lm.score_blocks(rows, lm.Vocabulary(), sent, bits)
    assert not whole and blocks.filter(F.size("buckets") > 0).count()
    assert "text" not in blocks.columns


def test_packed_numbers():
    import numpy as np
    for values in ([], [0], [1, 255], [256, 3], [2**64 - 1, 0, 7]):
        assert lm.unpack(lm.pack(np.array(values, np.uint64))).tolist() == values
    n = np.array([1, 2, 3, 4, 7, 8, 9, 31, 32, 1000, 2**40], np.uint64)
    assert (np.diff(lm.classes(n)) >= 0).all() and lm.classes(np.array([1], np.uint64))[0] == 0
