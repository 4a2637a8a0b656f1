import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import bag, day
from millrace.sources.control import control_totals
from millrace.sources.layout import Layout, run_stamp
from millrace.sources.sinks import (
    append_partitions, append_rows, create_table, overwrite_table, replace_partitions,
)
from millrace.sources.tables import scan_glob, scan_if_present, scan_recursive, scan_table


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, *rows):
    return spark.createDataFrame([(k, day(d)) for k, d in rows], "k int, date date")


def folders(path):
    return sorted(name for name in os.listdir(path) if "=" in name)


def files(path):
    return [name for _, _, names in os.walk(path) for name in names if name.endswith(".parquet")]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_scan_and_overwrite_in_any_format(spark, path, fmt):
    overwrite_table(spark.range(3), path, fmt)
    overwrite_table(spark.range(2), path, fmt)
    assert bag(scan_table(spark, path, fmt)) == [(0,), (1,)]


def test_a_missing_table_is_none_but_other_errors_are_raised(spark, path):
    assert scan_if_present(spark, path) is None
    os.makedirs(path)
    assert scan_if_present(spark, path) is None
    with pytest.raises(Exception):
        scan_if_present(spark, path, "no-such-format")


def test_recursive_scan_does_not_parse_folder_names(spark, path):
    append_partitions(frame(spark, (1, "2024-01-01")), path)
    assert scan_recursive(spark, path).columns == ["k"]
    assert scan_table(spark, path).columns == ["k", "date"]
    assert dict(scan_table(spark, path).dtypes)["date"] == "date"


def test_glob_scan(spark, path):
    for n, name in enumerate(["attempt1", "attempt2", "other"]):
        spark.range(n, n + 1).write.parquet(f"{path}/{name}")
    assert bag(scan_glob(spark, f"{path}/attempt*/*")) == [(0,), (1,)]
    assert bag(scan_glob(spark, f"{path}/attempt1/*", f"{path}/other/*")) == [(0,), (2,)]


def test_local_rows(spark):
    rows = [(day("2024-01-01"), 1, None)]
    assert bag(control_totals(spark, rows)) == rows
    assert control_totals(spark, rows).dtypes == [
        ("utc_date", "date"), ("hits_num", "bigint"), ("visitors_num", "bigint")]
    named = spark.createDataFrame([(1.5, "pass")], ["date", "null_check"])
    assert named.dtypes == [("date", "double"), ("null_check", "string")]


def test_partition_folders_are_plain_dates(spark, path):
    append_partitions(frame(spark, (1, "1995-06-20"), (2, "1995-06-21")), path)
    assert folders(path) == ["date=1995-06-20", "date=1995-06-21"]


def test_append_adds_again_and_replace_does_not(spark, path):
    old, new = frame(spark, (1, "2024-01-01")), frame(spark, (2, "2024-01-02"))
    append_partitions(old, path)
    for _ in range(2):
        replace_partitions(new, path)
    assert bag(scan_table(spark, path)) == bag(old.union(new))
    append_partitions(new, path)
    assert scan_table(spark, path).count() == 3


def test_replacing_nothing_changes_nothing(spark, path):
    old = frame(spark, (1, "2024-01-01"))
    append_partitions(old, path)
    replace_partitions(old.limit(0), path)
    append_partitions(old.limit(0), path)
    assert bag(scan_table(spark, path)) == bag(old)


def test_partitioned_overwrite_replaces_the_whole_table(spark, path):
    overwrite_table(frame(spark, (1, "2024-01-01")), path, by="date")
    overwrite_table(frame(spark, (2, "2024-01-02")), path, by="date")
    assert folders(path) == ["date=2024-01-02"]


def test_a_day_is_one_file_unless_it_is_large(spark, conf, path):
    days = F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 5).cast("int"))
    rows = spark.range(0, 5000, 1, 8).select(F.col("id").alias("k"), days.alias("date"))
    append_partitions(rows, path)
    assert len(files(path)) == 5


def test_a_hot_day_is_split_over_tasks(spark, conf, path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    hot = F.when(F.col("id") % 3 == 0, F.date_add(F.lit(day("2024-01-01")),
                                                  (F.col("id") % 50).cast("int")))
    rows = spark.range(0, 300_000, 1, 16).select(
        F.col("id").alias("k"), F.coalesce(hot, F.lit(day("2023-01-01"))).alias("date"))
    append_partitions(rows, path)
    assert len(files(f"{path}/date=2023-01-01")) > 3
    assert scan_table(spark, path).agg(F.sum("k")).first()[0] == sum(range(300_000))


def test_log_rows_are_appended(spark, path):
    append_rows(spark.range(1), path)
    append_rows(spark.range(1), path)
    assert bag(scan_table(spark, path)) == [(0,), (0,)]


def test_append_into_the_table_being_read(spark, path):
    append_rows(spark.range(3), path)
    table = scan_table(spark, path)
    append_rows(table.filter("id > 0"), path)
    assert bag(scan_table(spark, path)) == [(0,), (1,), (1,), (2,), (2,)]


def test_create_only_save(spark, path):
    create_table(spark.range(1), path)
    with pytest.raises(AnalysisException) as error:
        create_table(spark.range(1), path)
    assert error.value.getCondition() == "PATH_ALREADY_EXISTS"


def test_layout():
    layout, at = Layout("/base"), datetime(2024, 1, 2, 3, 4, 5)
    assert layout.table("silver", "users") == "/base/silver/users"
    assert layout.year("bronze", "clickstream", 2024) == "/base/bronze/clickstream/2024"
    assert layout.attempt("clickstream", at).endswith("/attempt20240102_030405")
    assert layout.qa_log("clickstream", at).endswith("/logs/20240102_030405")
    assert run_stamp(at) == "20240102_030405"
    with pytest.raises(ValueError):
        layout.table("platinum", "users")
