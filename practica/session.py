"""Session construction and shared-folder resolution.

Library code never creates a session; these helpers are for tests, the bench
and command-line use. On a cluster the session comes from the launcher and
``spark.checkpoint.dir`` names the shared folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that shape the plans at scale: adaptive execution re-plans joins
# from runtime sizes (broadcast only below the threshold), coalesces small
# shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def cluster_conf(largest_shuffle_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run, sized from the largest expected shuffle.

    The measures shuffle map-side partial aggregates, so the largest shuffle
    is far smaller than the raw time entries; start with enough partitions
    that each is ~``target_partition_bytes`` and let adaptive execution
    coalesce small ones and split skewed ones.
    """
    parts = max(200, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "practica", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PRACTICA_DRIVER_MEM", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Reads ``spark.checkpoint.dir`` (or the context checkpoint dir). When
    neither is set, a cluster run fails (a machine-local folder would not be
    shared); only a local-mode session -- tests -- gets a fresh scratch folder,
    registered so later calls agree.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="practica-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


CODEC = "zstd"      # of stored tables: keys are hexadecimal text, which it halves


def free_shuffles(spark: SparkSession) -> None:
    """Let go of what finished jobs have shuffled. Spark deletes it once the driver
    has collected its plans as garbage, which one with a large heap may not do
    before the end of a run of many jobs."""
    spark.sparkContext._jvm.System.gc()


def materialize(df, name: str = "materialized"):
    """Write ``df`` once as a parquet table in the shared folder
    (``spark.checkpoint.dir``) and return the stored table.

    Cuts the lineage: consumers read stored files, and a lost executor does
    not recompute the plan above it. (A reliable ``checkpoint()`` without a
    persist computes its input twice; a written table computes it once.)
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path, compression=CODEC)
    free_shuffles(spark)
    return spark.read.parquet(path)
