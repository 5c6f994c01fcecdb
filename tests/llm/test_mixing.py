import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np

from practica.llm import mixing

from .conftest import SCHEMA, rows, words


def by_quotient(votes, seats, most):
    held = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if held[i] < most[i] and votes[i] > 0]
        if not open_:
            break
        held[max(open_, key=lambda i: (Fraction(votes[i]) / (2 * held[i] + 1), -i))] += 1
    return held


def test_highest_quotients():
    rng = random.Random(1)
    for _ in range(200):
        votes = [rng.choice([0, 1, 5, rng.randrange(1000)]) for _ in range(rng.randrange(1, 9))]
        most = [rng.randrange(0, 60) for _ in votes]
        seats = rng.randrange(0, 120)
        got = mixing.sainte_lague(np.array(votes), seats, np.array(most)).tolist()
        assert sum(got) == sum(by_quotient(votes, seats, most))
        assert all(g <= m and (v or not g) for g, m, v in zip(got, most, votes))
        assert sorted(g and v / (2 * g - 1) for g, v in zip(got, votes)) == sorted(
            g and v / (2 * g - 1) for g, v in zip(by_quotient(votes, seats, most), votes))


def test_targets():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == [200, Fraction(250, 3), Fraction(500, 3)]
    assert mixing.targets([10, 1000, 0], [3, 1, 2]) == [20, 1495, 0]


def docs_of(spark):
    rng = random.Random(8)
    texts = [words(rng, rng.randrange(1, 400)) for _ in range(300)]
    return spark.createDataFrame(rows(texts, source=lambda i: "big" if i % 3 else f"s{i % 7}"), SCHEMA)


def test_taken_words_come_near_their_targets(spark, odd_docs):
    for docs in (docs_of(spark), odd_docs):
        got = mixing.mix_documents(docs).collect()
        size = defaultdict(int)
        for r in docs.select("source", "text").collect():
            size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        names = sorted(size, key=lambda s: (s is None, s or ""))
        want = mixing.targets([size[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))])
        assert {(r.source_size, round(r.target, 6)) for r in got} == {
            (size[s], round(float(t), 6)) for s, t in zip(names, want)}
        taken = defaultdict(int)
        for r in got:
            assert 0 <= r.taken <= 2 * r["size"]
            taken[r.source_size] += r.taken
        if len(set(size.values())) == len(size):
            for s, t in zip(names, want):
                assert abs(taken[size[s]] - t) <= 2 * mixing.BLOCK_WORDS
        again = mixing.mix_documents(docs.repartition(5)).collect()
        assert sorted(map(str, again)) == sorted(map(str, got))


def test_the_mix_holds_the_taken_words(spark, odd_docs):
    for docs in (docs_of(spark), odd_docs):
        taken = defaultdict(int)
        for r in mixing.mix_documents(docs).collect():
            taken[r.doc_id] += r.taken
        mixed = mixing.mixed_texts(docs)
        assert mixed.columns == docs.columns
        found = defaultdict(int)
        for r in mixed.collect():
            assert r.n_chars is None or r.n_chars == len(r.text)
            found[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert {k: v for k, v in taken.items() if v} == dict(found)


def test_empty(no_docs):
    assert mixing.mix_documents(no_docs).count() == 0 and mixing.mixed_texts(no_docs).count() == 0
