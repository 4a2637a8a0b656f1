import os

import pytest

from helpers import bag, day, money
from millrace.operators.incremental import after_watermark
from millrace.sources.layout import Layout
from millrace.sources.schemas import BRONZE_SCHEMAS
from millrace.sources.tables import scan_bronze, scan_table
from millrace.streaming.landing import ingest_landing, ingest_range, ingest_snapshot


@pytest.fixture
def layout(tmp_path):
    return Layout(str(tmp_path))


def deliver(spark, layout, folder, rows):
    """``(order, day)`` rows as one delivery of transactions."""
    full = [("a@x", ["p"], order, 1, money("1"), 1, "purchase", day(d)) for order, d in rows]
    (spark.createDataFrame(full, BRONZE_SCHEMAS["transactions"])
     .write.mode("append").parquet(f"{layout.landing('transactions')}/{folder}"))


def loaded(spark, layout):
    return bag(scan_bronze(spark, layout, "transactions").select("order_id", "utc_date"))


def test_stream_loads_each_file_once(spark, layout):
    deliver(spark, layout, "2024", [("1", "2024-01-01"), ("2", "2024-01-02")])
    for _ in range(2):
        ingest_landing(spark, layout, "transactions")
    assert loaded(spark, layout) == [("1", day("2024-01-01")), ("2", day("2024-01-02"))]
    deliver(spark, layout, "2023", [("late", "2023-12-31"), ("3", "2024-01-03")])
    ingest_landing(spark, layout, "transactions")
    assert [key for key, _ in loaded(spark, layout)] == ["1", "2", "3", "late"]


def test_a_backlog_is_loaded_in_steps(spark, layout):
    for n in range(3):
        deliver(spark, layout, str(n), [(str(n), f"2024-01-0{n + 1}")])
    ingest_landing(spark, layout, "transactions", max_bytes=1)
    assert [key for key, _ in loaded(spark, layout)] == ["0", "1", "2"]
    commits = os.listdir(f"{layout.checkpoint('transactions')}/commits")
    assert len([name for name in commits if name.isdigit()]) >= 3


def test_bronze_is_pruned_by_day(spark, layout):
    deliver(spark, layout, "a", [("1", "2024-01-01"), ("2", "2024-01-02")])
    ingest_landing(spark, layout, "transactions")
    bronze = after_watermark(scan_bronze(spark, layout, "transactions"), day("2024-01-01"))
    assert bag(bronze.select("order_id")) == [("2",)]
    plan = bronze._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(utc_date" in plan


def test_range_ingest_replaces_the_days_it_loads(spark, layout):
    deliver(spark, layout, "a", [("1", "2024-01-01"), ("2", "2024-01-02"), ("3", "2024-01-03")])
    for _ in range(2):
        ingest_range(spark, layout, "transactions", day("2024-01-01"), day("2024-01-02"))
    assert [key for key, _ in loaded(spark, layout)] == ["1", "2"]
    ingest_range(spark, layout, "transactions", day("2024-01-02"), day("2024-01-03"))
    assert [key for key, _ in loaded(spark, layout)] == ["1", "2", "3"]
    ingest_range(spark, layout, "transactions", day("2024-01-05"), day("2024-01-04"))
    assert len(loaded(spark, layout)) == 3


def test_snapshot_is_replaced(spark, layout):
    for name in ("old", "new"):
        (spark.createDataFrame([("p", name, money("1"))], BRONZE_SCHEMAS["products"])
         .write.mode("overwrite").parquet(layout.landing("products")))
        ingest_snapshot(spark, layout, "products")
    assert bag(scan_table(spark, layout.table("bronze", "products"))) == [("p", "new", money("1"))]


def test_no_bronze_rows_is_an_error(spark, layout):
    with pytest.raises(FileNotFoundError):
        scan_bronze(spark, layout, "transactions")


def test_files_with_old_times_are_loaded(spark, layout):
    deliver(spark, layout, "new", [("1", "2024-01-01")])
    ingest_landing(spark, layout, "transactions")
    deliver(spark, layout, "old", [("2", "2023-01-01")])
    folder = f"{layout.landing('transactions')}/old"
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        os.utime(path, (os.path.getmtime(path) - 10 * 86400,) * 2)
    ingest_landing(spark, layout, "transactions")
    assert [key for key, _ in loaded(spark, layout)] == ["1", "2"]
