"""What reaches the scan: filters, columns and folders."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import day, plan_of, silver_rows
from millrace.operators.gold import gold_daily_signed, gold_transactions
from millrace.operators.report import complete_months, monthly_sales, sales_report
from millrace.operators.silver import silver_transactions
from millrace.sources.schemas import BRONZE_SCHEMAS


def scans(df):
    return [line for line in plan_of(df).split("\n") if "FileScan" in line]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("plans"))
    silver_rows(spark, [("a", "p", f"2024-0{m}-10", "purchase", "1") for m in (1, 2, 3)]) \
        .write.partitionBy("date").parquet(f"{base}/silver")
    gold_transactions(spark.read.parquet(f"{base}/silver")) \
        .write.partitionBy("date").parquet(f"{base}/gold")
    spark.createDataFrame([], BRONZE_SCHEMAS["transactions"]).write.parquet(f"{base}/bronze")
    spark.createDataFrame([("p", "P")], "product_id string, product_name string") \
        .write.parquet(f"{base}/products")
    return {name: spark.read.parquet(f"{base}/{name}")
            for name in ("silver", "gold", "products", "bronze")}


def test_report_reads_three_columns_and_prunes_folders(tables):
    report = sales_report(tables["gold"], tables["products"], as_of=day("2024-02-29"))
    gold_scan = [line for line in scans(report) if "daily_signed_price" in line][0]
    schema = re.search(r"ReadSchema: (\S+)", gold_scan).group(1)
    assert "previous_purchase" not in schema and "email" not in schema
    assert "date" not in schema and "transaction_type" not in schema
    assert "PartitionFilters: [isnotnull(date" in gold_scan


def test_lazy_cutoff_prunes_folders_too(tables):
    months = complete_months(tables["gold"])
    assert months.count() == 2
    assert any("PartitionFilters: [isnotnull(date" in line and "ubquery" in line
               for line in scans(months))


def test_one_product_is_filtered_in_the_scan(tables):
    report = sales_report(tables["gold"], tables["products"], "p", day("2024-02-29"))
    assert any("PushedFilters: [IsNotNull(product_id), EqualTo(product_id,p)]" in line
               for line in scans(report))


def test_report_needs_no_window_over_customers(tables):
    plan = plan_of(monthly_sales(gold_transactions(tables["silver"])))
    assert "Window" not in plan


def test_date_filter_passes_explode_and_join(tables):
    out = silver_transactions(tables["bronze"], tables["products"].withColumn("price", F.lit(1)))
    assert any("GreaterThan(utc_date,2024-02-01)" in line
               for line in scans(out.filter(F.col("date") > F.lit(day("2024-02-01")))))


def test_date_parts_do_not_widen_the_shuffle(tables):
    shuffle = [line for line in plan_of(gold_daily_signed(tables["silver"])).split("\n")
               if "hashpartitioning" in line]
    assert len(shuffle) == 1 and "year" not in shuffle[0]
