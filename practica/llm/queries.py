"""One registered query for each operator, over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from practica.llm import ann_tree, conversations, jaccard_join, lm_scoring, mixing, packing, phrases, piece_table, quality_llr, secret_ledger, sharding, toxicity, url_filter
from practica.llm.common import read_table
from practica.session import shared_dir

# A page of so few links (a dead end) puts its URL on the list, whatever that is.
MOST_LINKS = 4
LINK = "<a "


def op1_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: documents labelled of good quality."""
    trusted = read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_scoring.score_documents(read_table(spark, sf_dir, "documents"), trusted)


def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op3_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(read_table(spark, sf_dir, "documents")).drop("digest")


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of two runs: the documents of one half of the sources arrive
    first, then all, of which the second run scans what the first hasn't seen."""
    docs = read_table(spark, sf_dir, "documents")
    ledger = f"{shared_dir(spark).rstrip('/')}/secret_ledger/{uuid.uuid4().hex}"
    secret_ledger.scan_new(docs.filter(F.xxhash64(F.coalesce("source", F.lit(""))) % 2 == 0), ledger)
    return secret_ledger.report(*secret_ledger.scan_new(docs, ledger))


def op5_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op6_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted target: documents labelled of good quality."""
    trusted = read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality_llr.judge_quality(read_table(spark, sf_dir, "documents"), trusted)


def op7_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op8_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed: the URLs of pages with at most ``MOST_LINKS`` links in their html;
    all pages meet the list under their canonical URL."""
    pages = read_table(spark, sf_dir, "pages")
    links = F.length("html") - F.length(F.replace(F.col("html"), F.lit(LINK), F.lit("")))
    return url_filter.filter_urls(pages, pages.filter(links <= MOST_LINKS * len(LINK)).select("url"))


def op9_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents"))


def op10_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_piece_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_table.digest_documents(read_table(spark, sf_dir, "documents"))


def op12_phrase_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_conversations(read_table(spark, sf_dir, "conversations"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
