"""Training-data pipeline over the table ``documents``.

Each stage takes (session, documents, input directory) and returns documents,
the last one packed pieces; what it returns is written as Parquet in the shared
folder and read again by the next, so a lost executor costs one stage's tasks.
A stage's table is deleted once the next one's is written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from practica.llm import jaccard_join, mixing, packing, secret_ledger, toxicity
from practica.llm.common import read_table
from practica.operators.parts import drop_folder
from practica.session import shared_dir


LEDGER = "secret_ledger/pipeline"   # below the shared folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance does not judge toxic."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return jaccard_join.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets replaced. The ledger outlives a run: texts
    that an earlier one has scanned are not scanned again."""
    return secret_ledger.redact_documents(docs, f"{shared_dir(spark).rstrip('/')}/{LEDGER}")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often, and as far, as their blocks are taken."""
    return mixing.mixed_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram jaccard join", drop_near_copies),
    ("secret scans", redact_secrets),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

# The classifier, the forest and the packing have no SQL form; tests compare the
# operators of the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents"), None
    root = f"{shared_dir(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        if before is not None:
            drop_folder(spark, before)
        before = f"{root}/{i}"
    return docs
