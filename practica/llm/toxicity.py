"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
Each is put before the same common base (a dictionary of ordinary words), so
that text which neither knows costs the same under both. A document is cut into
overlapping windows; each window is compressed under both dictionaries and the
difference of the two lengths is taken. The shares of the document's windows at
each difference, the largest differences and the logarithms of how many windows
reach some are the inputs of a logistic calibration, whose score at 0.5 separates
the classes.

Learning uses at most ``TOXIC_SAMPLE`` + ``ORDINARY_SAMPLE`` labelled rows, the
first by a hash of their id; equal texts count once. Toxic training text is
those words of the toxic sample that are over-represented there by a
two-proportion test, ordinary text the other words; words are counted in Spark
and at most ``VOCABULARY`` of each kind reach the driver. With many labels,
near copies of toxic texts make chance words look certain, so the least z-score
is chosen among ``LEVELS`` by the cross-validated loss of the calibration. The
toxic dictionary is as long as it takes to hold every toxic word at that level,
the ordinary one as long as the toxic one. A quarter of the
sample, apart from the words, fits the calibration; only its window shares reach
the driver. All documents are scored whole, without a shuffle.

Defined results: a null text is the empty text, scored like a text whose
windows show no difference. Conflicting labels of an id count as toxic; rows
with a null label or id teach nothing. Without examples of both classes the
score is 0. Repeated rows are scored each. A null id is held out by the CRC of
the empty text (which is 0). An empty table gives an empty result.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from practica.llm.common import map_batches, texts_of
from practica.llm.tokens import worker_cache
from practica.session import materialize

TOXIC_SAMPLE, ORDINARY_SAMPLE = 3_000, 9_000
VOCABULARY = 20_000
TRAINING_WORDS = 60_000
FOLDS = 5                   # rows whose CRC leaves 0 are held out
WINDOW, OVERLAP = 64, 16    # bytes
TOXIC_BYTES, BASE_BYTES = 1024, 16384
LEVEL = 12
# Least z-scores to choose from, and the least ratio of a toxic word.
LEVELS, LEAST_RATIO = (4.0, 5.0, 6.0, 8.0, 10.0, 13.0), 4.0
LEAST, MOST = -6, 12        # differences beyond are counted at the ends
REACHED = (2, 3, 4, 5, 6, 8)
PARTS = 4                   # of the calibration rows, to choose the level
SEED = 7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS, F.lit(0)) == 0


def normal(text: str) -> str:
    """Lower case, single spaces, a space at either end."""
    return " " + " ".join(text.lower().split()) + " "


def windows(text: str) -> list[bytes]:
    data = normal(text).encode()
    return [data[i:i + WINDOW + OVERLAP] for i in range(0, len(data), WINDOW)]


class Distance:
    """Window compression lengths under the two dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        import zstandard

        def under(dictionary: bytes):
            data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False,
                                            write_checksum=False).compress
        self.ordinary, self.toxic = under(ordinary), under(toxic)

    def shares(self, text: str) -> np.ndarray:
        """Shares of the windows at each difference, their mean, the largest, the
        means of the two and four largest, logarithms of the numbers of windows
        that reach a difference and of all."""
        a, b = self.ordinary, self.toxic
        diff = np.sort(np.array([len(a(w)) - len(b(w)) for w in windows(text)]))[::-1]
        counts = np.bincount(np.clip(diff, LEAST, MOST) - LEAST, minlength=MOST - LEAST + 1)
        top = [diff[:k].mean() for k in (1, 2, 4)]
        reached = np.log1p([(diff >= k).sum() for k in REACHED])
        return np.concatenate([counts / len(diff), [diff.mean()], top, reached, [math.log(len(diff))]])


def distance(dictionaries: tuple[bytes, bytes]) -> Distance:
    """The process's compressors for these dictionaries."""
    cache = worker_cache().__dict__
    if cache.get("toxicity_for") != dictionaries:
        cache["toxicity"], cache["toxicity_for"] = Distance(*dictionaries), dictionaries
    return cache["toxicity"]


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, fit): bounded, stored; equal texts once."""
    known = (labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter("doc_id is not null and toxic is not null").filter(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .withColumn("_draw", F.xxhash64("doc_id", F.lit(SEED))))
    some = [known.filter(F.col("toxic") == kind).orderBy("_draw", "doc_id").limit(n)
            for kind, n in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE))]
    chosen = materialize(some[0].unionByName(some[1]), "toxicity_chosen")
    # At most TOXIC_SAMPLE + ORDINARY_SAMPLE rows, whatever the input.
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "doc_id").withColumn("_md", F.md5("text")))
    once = rows.groupBy("_md").agg(F.max_by(F.struct("text", "toxic"), F.struct("toxic", "doc_id")).alias("r"),
                                   F.min("_draw").alias("_draw"))
    return materialize(once.select("r.text", "r.toxic", (F.pmod("_draw", F.lit(4)) == 0).alias("fit")),
                       "toxicity_sample")


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, n_toxic, n_ordinary): documents of each class that hold the word."""
    words = F.explode_outer(F.array_distinct(F.expr(r"regexp_extract_all(lower(text), '[\\p{L}]+', 0)")))
    return (sample.select("toxic", words.alias("word")).groupBy("word")
            .agg(F.sum("toxic").alias("n_toxic"), F.sum(1 - F.col("toxic")).alias("n_ordinary"))
            .filter("word is not null"))


def train_dictionary(words: list[tuple[str, int]], size: int, seed: int = SEED) -> bytes:
    """A zstandard dictionary of about ``TRAINING_WORDS`` words of text, in
    which each word stands in proportion to its count."""
    import zstandard
    each = TRAINING_WORDS / max(1, sum(n for _, n in words))
    text = [w for w, n in words for _ in range(math.ceil(n * each))]
    random.Random(seed).shuffle(text)
    samples = [(" " + " ".join(text[i:i + 8]) + " ").encode() for i in range(0, len(text), 8)]
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:     # too little text to train on: it is the dictionary
        return b"".join(samples)[-size:]


def with_all(words: list[str], dictionary: bytes) -> bytes:
    """``dictionary`` behind those of the words that it does not hold."""
    text = dictionary.decode("utf-8", "ignore")
    missed = [w for w in words if f" {w} " not in text]
    return (" " + " ".join(missed) + " ").encode() + dictionary if missed else dictionary


def ranked_words(sample: DataFrame) -> tuple[list[tuple], list[tuple]] | None:
    """Words that may be toxic, most certain first, as (word, n_toxic, n_ordinary,
    z), and the others, most frequent first, as (word, n_ordinary)."""
    learn = sample.filter(~F.col("fit"))
    n_ordinary, n_toxic = (learn.filter(F.col("toxic") == k).count() for k in (0, 1))
    if not n_toxic or not n_ordinary:
        return None
    counts = word_counts(learn)
    a, b = F.col("n_toxic") / n_toxic, F.col("n_ordinary") / n_ordinary
    p = (F.col("n_toxic") + F.col("n_ordinary")) / (n_toxic + n_ordinary)
    z = (a - b) / F.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_ordinary) + 1e-12)
    counts = counts.withColumn("z", z).withColumn("over", (F.col("z") > LEVELS[0]) & (a > LEAST_RATIO * b))
    over = counts.filter("over").orderBy(F.desc("z"), "word").limit(VOCABULARY)
    rest = counts.filter(~F.col("over")).orderBy(F.desc("n_ordinary"), "word").limit(VOCABULARY)
    return ([tuple(r) for r in over.select("word", "n_toxic", "n_ordinary", "z").collect()],
            [tuple(r) for r in rest.select("word", "n_ordinary").collect()])


def pair_at(ranked: tuple[list[tuple], list[tuple]], least: float) -> tuple[bytes, bytes]:
    """The two dictionaries with toxic words of a z-score above ``least``."""
    over, rest = ranked
    toxic = [(w, n) for w, n, _, z in over if z > least]
    plain = sorted([*rest, *((w, n) for w, _, n, z in over if z <= least)], key=lambda x: (-x[1], x[0]))
    plain = [x for x in plain if x[1]]
    base = train_dictionary(plain, BASE_BYTES, SEED + 1)
    held = with_all([w for w, _ in toxic], train_dictionary(toxic, TOXIC_BYTES))
    return train_dictionary(plain, max(TOXIC_BYTES, len(held))) + base, held + base


def dictionaries(sample: DataFrame, least: float = LEVELS[0]) -> tuple[bytes, bytes] | None:
    ranked = ranked_words(sample)
    return None if ranked is None else pair_at(ranked, least)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and intercept on the inputs as they are."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    keep = np.append(np.full(x.shape[1], ridge), 1e-6)
    w = np.zeros(a.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(keep), a.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def loss_between_parts(x: np.ndarray, y: np.ndarray) -> float:
    """Mean log loss on each part of the rows, fitted on the others."""
    part, losses = np.arange(len(y)) % PARTS, []
    for k in range(PARTS):
        if len(set(y[part != k])) < 2:
            continue
        weights, intercept = fit_logistic(x[part != k], y[part != k])
        at = np.clip(x[part == k] @ weights + intercept, -30, 30)
        losses.append(np.logaddexp(0, np.where(y[part == k] > 0, -at, at)))
    return float(np.concatenate(losses).mean()) if losses else math.inf


def train(docs: DataFrame, labels: DataFrame) -> tuple | None:
    """((ordinary, toxic) dictionaries, weights, intercept); None without
    examples of both classes."""
    sample = labelled_sample(docs, labels)
    ranked = ranked_words(sample)
    if ranked is None:
        return None
    best = max([z for *_, z in ranked[0]], default=0.0)
    found = [pair_at(ranked, z) for z in LEVELS if z < best or z == LEVELS[0]]

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        shares = [[] for _ in texts]
        for pair in found:
            for row, text in zip(shares, texts):
                row += distance(pair).shares(text).tolist()
        return {"toxic": batch.column("toxic"), "shares": pa.array(shares, pa.list_(pa.float64()))}

    rows = map_batches(sample.filter("fit").select("text", "toxic"), run, "toxic int, shares array<double>").collect()
    if len({r["toxic"] for r in rows}) < 2:
        return None
    rows = sorted((r["toxic"], tuple(r["shares"])) for r in rows)
    x, y = np.array([r[1] for r in rows]), np.array([r[0] for r in rows], float)
    inputs = np.split(x, len(found), axis=1)
    chosen = min(range(len(found)), key=lambda k: loss_between_parts(inputs[k], y))
    return found[chosen], *fit_logistic(inputs[chosen], y)


def score_documents(docs: DataFrame, model: tuple | None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       held_out(F.col(id_col)).alias("held_out"))

    def run(batch: pa.RecordBatch) -> dict:
        scores = [score_text(t, model) for t in texts_of(batch)]
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                "score": pa.array(scores, pa.float64()),
                "predicted": pa.array([int(s >= 0.5) for s in scores], pa.int32())}

    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def score_text(text: str, model: tuple | None) -> float:
    if model is None:
        return 0.0
    found, weights, intercept = model
    at = float(distance(found).shares(text) @ weights) + intercept
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, at))))


def drop_toxic(docs: DataFrame, model: tuple | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows predicted toxic, all columns; texts stay in
    place."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([score_text(t, model) < 0.5 for t in texts_of(batch, text_col)]))
    return map_batches(docs, run, docs.schema)
