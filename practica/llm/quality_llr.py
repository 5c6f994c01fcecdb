"""Quality rules and a hashed n-gram log-likelihood ratio, in built-in functions.

Base rules count words, symbols, repeated lines and repeated 3-word windows of
every whole text. The model: words and word pairs are hashed into ``BUCKETS``
buckets; two multinomials are counted over *all* rows, one of the trusted
target rows and one of the raw corpus; a text's score is the sum of the
log ratios of its n-grams divided by their number. Every text at or above the
threshold is kept, every other one dropped.

The counts shuffle at most ``BUCKETS`` partial sums a task, and the model (one
double a bucket) reaches the rows as one array value, so scoring has no shuffle.

Defined results: a null text is the empty text; it has no words and fails the
base rules. Without target rows every ratio is 0 and only the base rules
decide. Repeated rows are judged alike and count as often as they occur. Rows
with a null id are judged, never trusted. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from practica.llm.common import SPACE_CHARS, small_side
from practica.session import materialize

BUCKETS = 1 << 14
SMOOTHING = 1.0
# Mean log ratio (nats an n-gram) from which a text is kept.
THRESHOLD = -0.06
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def text_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_text``, ``_words`` (array) and ``_hashes`` (a 64-bit
    hash for each word)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(F.col("_text"), r"[\x20\x09-\x0D]+"), "")
    return (docs.withColumn("_text", text).withColumn("_words", words)
            .withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))))


def ngram_buckets(hashes: str = "_hashes", buckets: int = BUCKETS) -> Column:
    """Buckets of all words and all pairs of neighbours."""
    h = F.col(hashes)
    one = F.transform(h, lambda x: F.pmod(x, F.lit(buckets)).cast("int"))
    two = F.transform(F.slice(h, 2, F.greatest(F.size(h) - 1, F.lit(0))),
                      lambda x, i: F.pmod(F.xxhash64(F.get(h, i), x), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def base_counts(df: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text, words, hashes = F.col("_text"), F.col("_words"), F.col("_hashes")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = (df.withColumn("n_words", F.size(words).cast("long"))
          .withColumn("word_chars", F.char_length(F.translate(text, SPACE_CHARS, "")).cast("long"))
          .withColumn("n_symbols", F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"))
          .withColumn("_lines", lines)
          .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
          .withColumn("_windows", F.transform(
              F.slice(hashes, 3, F.greatest(F.size(hashes) - 2, F.lit(0))),
              lambda x, i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), x))))
    # Windows that occur twice or more stand beside their equals once sorted.
    repeats = F.size("_windows") > F.size(F.array_distinct("_windows"))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(repeats, placed))
    twice = F.filter("_sorted", lambda x, k: F.coalesce(
        (x["h"] == F.get("_sorted", k - 1)["h"]), F.lit(False)) | F.coalesce(
        (x["h"] == F.get("_sorted", k + 1)["h"]), F.lit(False)))
    df = df.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_starts", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_starts", k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))


def llr_model(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str,
              buckets: int = BUCKETS) -> DataFrame:
    """(bucket, llr) for every bucket, counted over all rows and stored."""
    trusted = trusted.select(F.col(id_col).alias("_id")).filter("_id is not null").distinct()
    trusted = materialize(trusted, "trusted_ids")
    side = small_side(trusted.withColumn("_trusted", F.lit(1)), trusted.count())
    grams = (text_features(docs.select(F.col(id_col).alias("_id"), F.col(text_col)), text_col)
             .select("_id", ngram_buckets(buckets=buckets).alias("_grams"))
             .join(side, "_id", "left")
             # explode_outer: explode adds a filter that repeats the n-gram expression
            .select(F.coalesce("_trusted", F.lit(0)).alias("_trusted"), F.explode_outer("_grams").alias("bucket")))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("_trusted").alias("target"))
    every = (docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
             .join(counts, "bucket", "left").na.fill(0, ["raw", "target"]))
    every = materialize(every, "ngram_counts")
    raw, target = every.agg(F.sum("raw"), F.sum("target")).first()
    if not target:
        return every.select("bucket", F.lit(0.0).alias("llr"))
    add = F.lit(SMOOTHING)
    return every.select("bucket", (F.log((F.col("target") + add) / (target + SMOOTHING * buckets))
                                   - F.log((F.col("raw") + add) / (raw + SMOOTHING * buckets))).alias("llr"))


def judge_quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """One row per document: the base counts, base_failed, score and kept."""
    model = llr_model(docs, trusted, id_col, text_col, buckets)
    ratios = model.select(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "llr"))),
                                      lambda s: s["llr"])).scalar()
    df = base_counts(text_features(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)), text_col))
    df = df.withColumn("_grams", ngram_buckets(buckets=buckets)).withColumn("_llr", ratios)
    score = F.aggregate("_grams", F.lit(0.0), lambda a, g: a + F.get("_llr", g)) / F.greatest(
        F.size("_grams"), F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words")
                                               > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (df.withColumn("score", score).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept", "score"))
