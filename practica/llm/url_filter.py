"""URL filter: a blocked Bloom filter of listed canonical URLs passes possible
hits to an exact join, which removes the false positives.

The filter is a table of blocks, 8 words of 64 bits each; a URL sets one bit in
each word of its block. It is built with ``bit_or`` by block (partial aggregates
before the shuffle) and probed by a join on the block. The filter is broadcast
only while its size, known from the counted list, is at most
``BROADCAST_FILTER_BYTES``; a larger one is joined by shuffle. Pages are read
once, into a stored table of what is judged; URLs that miss the filter, or have a
rule, never enter the exact join.

Rules decide before the list: a rule fits its host and all subdomains if the
path starts with the rule's path; the longest rule wins.

Defined results: a null URL, or one without ``://``, has empty host and path,
matches no rule and no listed URL, and is allowed. Repeated rows are each
judged. An empty list blocks nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from practica.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8                   # 64-bit words in a block
BITS_PER_URL = 16
BROADCAST_FILTER_BYTES = 32 << 20
# Fixed values: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical_of(url: Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slashes,
    query without ``utm_`` parameters; no scheme, no fragment. Null where the
    URL has no host."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), r"^&", "")
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query))
                                       .otherwise(F.lit(""))))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; nulls where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bits(url: Column) -> list[Column]:
    h = F.xxhash64(url, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def bloom_filter(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """(block, w0..w7): the bits that the listed URLs set."""
    return (listed.select(_block(F.col(url), blocks).alias("block"),
                          *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(url)))])
            .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]))


def possible_hits(pages: DataFrame, bloom: DataFrame, blocks: int, rules=RULES, id_col: str = "page_id",
                  url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, canonical, rule, verdict, and
    ``possible``: no rule fits and the filter holds the URL, truly or not."""
    url = F.col(url_col)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = (pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                           canonical_of(url).alias("canonical"))
              .withColumns({"rule": rule, "verdict": verdict}))
    hit = F.col("w0").isNotNull() & F.col("canonical").isNotNull() & F.col("rule").isNull()
    for i, b in enumerate(_bits(F.col("canonical"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(b) == b)
    return (judged.withColumn("block", _block(F.col("canonical"), blocks)).join(bloom, "block", "left")
            .select(*judged.columns, F.coalesce(hit, F.lit(False)).alias("possible")))


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id",
                url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and ``listed``
    (true where the exact join confirmed the URL)."""
    known = materialize(listed.select(canonical_of(F.col(listed_col)).alias("canonical"))
                        .filter("canonical is not null").distinct(), "url_list")
    n = known.count()
    blocks = max(1, -(-n * BITS_PER_URL // (64 * WORDS)))
    bloom = bloom_filter(known, "canonical", blocks)
    if blocks * (WORDS + 1) * 8 <= BROADCAST_FILTER_BYTES:
        bloom = F.broadcast(bloom)

    judged = materialize(possible_hits(pages, bloom, blocks, rules, id_col, url_col), "url_judged")
    missed = judged.filter(~F.col("possible")).withColumn("listed", F.lit(False))
    found = (judged.filter("possible").join(known.withColumn("_in", F.lit(True)), "canonical", "left")
             .withColumn("listed", F.col("_in").isNotNull()))
    out = ["page_id", "host", "path", "rule", "verdict", "listed"]
    every = missed.select(*out).unionByName(found.select(*out))
    return every.withColumn("verdict", F.coalesce("verdict", F.when(F.col("listed"), F.lit("block"))
                                                  .otherwise(F.lit("allow"))))
