"""Session settings the operators are designed for."""

from __future__ import annotations

import math
import re
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Not Spark's defaults, and needed wherever the operators run: an aggregation after a join on
# the same key must not keep AQE from splitting a hot key's partition of that join.
SKEW_SETTINGS = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# What one task may take in, in bytes of shuffled rows and of files. Rows take 13 to 40 times their shuffled size in
# a task's sorts and hash tables, and AQE merges shuffle partitions up to this size: below Spark's own 64 MB the
# memory of a task grew with the input (late rows of 24 times sf0.1: 854 MB).
TASK_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 << 20),
    "spark.sql.files.maxPartitionBytes": str(32 << 20),
}

# Bytes of input files for each partition a shuffle starts with, and partitions beyond which ``scale_settings`` rules.
INPUT_SHARE = 4 << 20
MOST_PARTITIONS = 20_000

# UTC because epoch columns are named *_utc_* / *_gmt_*; AQE because hot keys and hot days
# are split at run time (skew join for joins, rebalance for partitioned writes).
BASE_SETTINGS = {
    **SKEW_SETTINGS,
    **TASK_SETTINGS,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "millrace", master: str | None = None,
                  settings: dict[str, str] | None = None) -> SparkSession:
    """A session with ``BASE_SETTINGS``; ``settings`` are applied last and win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_settings(spark: SparkSession) -> SparkSession:
    """Put ``SKEW_SETTINGS`` on a session built elsewhere."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def byte_size(text: str) -> int:
    """A size as Spark's settings have it: ``64MB``, ``8m`` or plain bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def input_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files below a folder, from their listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]


def bound_tasks(spark: SparkSession, folder: str) -> SparkSession:
    """Keep a task's share of a job over the tables in ``folder`` from growing with them, on a session built elsewhere.

    Larger sizes of ``TASK_SETTINGS`` are lowered. Shuffles start with partitions in proportion to the input, which AQE
    merges, so that the advisory size is what decides.
    """
    for key, value in TASK_SETTINGS.items():
        if byte_size(spark.conf.get(key)) > int(value):
            spark.conf.set(key, value)
    share = min(MOST_PARTITIONS, math.ceil(input_bytes(spark, folder) / INPUT_SHARE))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                   str(max(share, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def scale_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle settings for an input of ``input_bytes`` on ``cores`` executor cores.

    The shuffle starts fine enough that a reducer's share is about 128 MB even if everything
    read is shuffled; AQE merges the small ones afterwards, so too many costs little while
    too few spills. At least one partition per core, so that no core idles.
    """
    partitions = max(cores, math.ceil(input_bytes / TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names, else (local master only) a new one.

    On a cluster a folder of one machine would be a different one for every executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not is_local(spark.conf.get("spark.master", "")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="millrace-")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")
