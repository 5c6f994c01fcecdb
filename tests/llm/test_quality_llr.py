import math
import re

from practica.llm import quality_llr as quality


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    where = {}
    for i in range(len(w) - 2):
        where.setdefault(tuple(w[i:i + 3]), []).append(i)
    repeated = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated))


def trusted(docs):
    return docs.filter("doc_id % 2 = 0").select("doc_id")


def test_base_counts_and_scores(odd_docs):
    texts = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = quality.judge_quality(odd_docs, trusted(odd_docs)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got),
                  key=key) == sorted(((i, *base(t)) for i, t in texts), key=key)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)


def test_ratios_against_plain_counts(spark, odd_docs):
    """The model's totals are those of all words and pairs, and its ratios
    follow from its counts."""
    model = {r.bucket: r.llr for r in quality.llr_model(odd_docs, trusted(odd_docs), "doc_id", "text", 64).collect()}
    assert sorted(model) == list(range(64))
    from pyspark.sql import functions as F
    grams = quality.text_features(odd_docs.select("doc_id", "text")).select(
        "doc_id", quality.ngram_buckets(buckets=64).alias("g")).collect()
    raw, target = [0] * 64, [0] * 64
    for r in grams:
        for g in r.g:
            raw[g] += 1
            target[g] += r.doc_id is not None and r.doc_id % 2 == 0
    words = [base(t.text)[0] for t in odd_docs.select("text").collect()]
    assert sum(raw) == sum(n + max(0, n - 1) for n in words)
    for b, llr in model.items():
        assert math.isclose(llr, math.log((target[b] + 1) / (sum(target) + 64))
                            - math.log((raw[b] + 1) / (sum(raw) + 64)), abs_tol=1e-9)
    scored = quality.judge_quality(odd_docs, trusted(odd_docs), buckets=64).filter(F.col("doc_id") == 6).first()
    g = next(r.g for r in grams if r.doc_id == 6)
    assert math.isclose(scored.score, sum(model[b] for b in g) / len(g), abs_tol=1e-9)


def test_nothing_trusted_and_empty(odd_docs, no_docs):
    got = quality.judge_quality(odd_docs, trusted(no_docs)).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in got)
    assert quality.judge_quality(no_docs, trusted(no_docs)).count() == 0
