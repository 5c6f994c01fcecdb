import random
import re
from collections import Counter, defaultdict

import pytest

from practica.llm import phrases

from .conftest import rows

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
        found = [w for w in re.split("[ \t]+", piece) if w]
        if found:
            yield found


def brute(docs, least=10, top=2000):
    count = defaultdict(Counter)
    for r in docs:
        for w in pieces(r.text):
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    count[r.lang if r.lang is not None else "und"][tuple(w[i:i + k])] += 1
    out = []
    for lang, f in count.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in candidates.items()):
                continue
            s, k, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                    for k in range(1, len(p)))
            best.append((-s, -a, " ".join(p).encode(), left, right))
        for i, (s, a, p, left, right) in enumerate(sorted(best)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ünder", "É", "new", "york", "CITY", "x" * 40, "🙂", "no\u00a0break", "\x1c", "a\x85b", "li\u2028ne", "\u3000"]
    stops = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", "!? ", " ; ", "\r\n", "\x0b"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(stops) for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += ["New York city is New York CITY. new york"] * 40 + ["a a a a a a a a, b b"] * 12 + [None, "", " \n\t. "]
    texts += ["the " * 300, "one two three four five six seven eight nine ten " * 30]
    data = [(*r[:2], rng.choice(["en", "de", None, ""]), *r[3:]) for r in rows(texts)]
    return spark.createDataFrame(data + data[:30], "doc_id long, text string, lang string, phrase string, n_chars long, "
                                 "n string, rank string, chunk string, score string, l string, r string, a string, "
                                 "key string, total string")


@pytest.mark.parametrize("period,bits,top", [(12, 16, 2000), (1, 6, 7), (1000, 20, 2000)])
def test_equals_counting_all_phrases(spark, period, bits, top):
    docs = corpus(spark)
    got = phrases.collocations(docs, period=period, mark_bits=bits, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(docs.collect(), top=top)


def test_chunks_hold_every_phrase_once():
    rng = random.Random(2)
    text = ". ".join(" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 40))) for _ in range(60))
    for period in (1, 4, 1000):
        found = Counter()
        for chunk in phrases.parse([text], period):
            own, _, over = chunk.decode().partition("\t")
            own, w = own.split(" "), [*own.split(" "), *over.split()]
            found.update(tuple(w[i:i + k]) for i in range(len(own)) for k in (1, 2, 3) if i + k <= len(w))
        assert found == Counter(tuple(w[i:i + k]) for w in pieces(text) for k in (1, 2, 3) for i in range(len(w) - k + 1))


def test_equal_passages_give_equal_chunks(spark):
    rng = random.Random(9)
    passage = " ".join(f"w{rng.randrange(500)}" for _ in range(400))
    texts = [f"{' '.join(f'v{rng.randrange(99)}' for _ in range(i % 7))} {passage}" for i in range(50)]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    chunks = phrases.chunk_dictionary(docs).collect()
    assert len(chunks) < 400 and max(r["n"] for r in chunks) == 50


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, left, right = 10 ** 12 + 7, 3 * 10 ** 12 + 1, 10 ** 13 + 9
    got = spark.range(1).select(phrases.score(*map(F.lit, (a, left, right))).alias("s")).first()["s"]
    assert got == 10 ** 6 * a * a // (left * right)


def test_empty_table(spark, no_docs, odd_docs):
    assert phrases.collocations(no_docs).count() == 0
    assert sorted(map(tuple, phrases.collocations(odd_docs).collect())) == brute(odd_docs.collect())
