from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.session import BASE_SETTINGS, TASK_SETTINGS, byte_size, scale_settings, shared_folder


def test_session_has_the_settings(spark):
    assert all(spark.conf.get(key) == value for key, value in BASE_SETTINGS.items())


def test_partitions_grow_with_the_input():
    small, large = scale_settings(10**9, 64), scale_settings(10**14, 8000)
    assert small["spark.sql.shuffle.partitions"] == "64"
    assert int(large["spark.sql.shuffle.partitions"]) == -(-10**14 // 2**27)


def named(folder, master="local[2]"):
    values = {"spark.checkpoint.dir": folder, "spark.master": master}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: values[key]))


def test_the_folder_the_cluster_names_is_used(tmp_path):
    assert shared_folder(named("hdfs://x/shared/")) == "hdfs://x/shared"
    assert shared_folder(named(None)) != shared_folder(named(None))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(named(None, master))


@pytest.mark.parametrize("text, size", [("8388608", 8 << 20), ("64MB", 64 << 20), ("16m", 16 << 20), ("1g", 1 << 30), ("512k", 512 << 10), ("7b", 7)])
def test_sizes_as_settings_have_them(text, size):
    assert byte_size(text) == size


@pytest.mark.parametrize("key", ["last_entries", "late_rows", "medallion_run"])
def test_share_of_a_task_does_not_grow_with_the_tables(spark, conf, monkeypatch, key):
    """On a session with Spark's own sizes; partitions follow the bytes of the tables."""
    advisory, files, initial = (*TASK_SETTINGS, "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    conf(advisory, "64MB")
    conf(files, "1m")
    conf(initial, "1")
    monkeypatch.setitem(entry.REGISTRY, key, lambda spark, sf_dir: spark.range(1))
    monkeypatch.setattr("millrace.session.INPUT_SHARE", 1 << 16)
    entry.queries()[key](spark, entry.SMOKE_DIR)
    total = sum(path.stat().st_size for path in Path(entry.SMOKE_DIR).iterdir())
    assert byte_size(spark.conf.get(advisory)) == int(TASK_SETTINGS[advisory]) <= 8 << 20
    assert spark.conf.get(files) == "1m"
    assert int(spark.conf.get(initial)) == -(-total // (1 << 16)) > 4


def test_merged_partitions_stay_below_the_share(spark, conf, monkeypatch):
    monkeypatch.setitem(TASK_SETTINGS, "spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1 << 15))
    monkeypatch.setattr("millrace.session.INPUT_SHARE", 1 << 15)
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    conf("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "1")
    conf("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    rows = spark.range(200_000).selectExpr("hash(id) AS k")
    grouped = entry.bounded(lambda spark, sf_dir: rows.groupBy("k").count())(spark, entry.SMOKE_DIR)
    assert grouped.select(F.spark_partition_id().alias("p")).distinct().count() > 8
