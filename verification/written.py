"""Queries whose point is writing: each writes tables to a new folder and returns what is there.

The folder lies below the one the cluster names for intermediate data (``shared_folder``).
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import MONEY
from millrace.operators.lookups import broadcast_if_small
from millrace.operators.silver import silver_clickstream, silver_transactions
from millrace.operators.snapshots import require_unique
from millrace.plans.pipeline import PipelineConfig, run_pipeline
from millrace.plans.quality import (
    check_delivered_columns, check_history, columns_path, counts_of_days, repair_clickstream, summarise_days,
    transaction_checks_between,
)
from millrace.session import shared_folder
from millrace.sources.layout import Layout
from millrace.sources.sinks import append_rows, overwrite_table, replace_partitions
from millrace.sources.tables import scan_bronze, scan_recursive, scan_table
from millrace.streaming.landing import ingest_landing, ingest_range, ingest_snapshot
from verification import scenarios as sc

RUN_AT = datetime(2024, 2, 1, 12, 0, 0)
SPLIT = date(2024, 1, 20)


def new_layout(spark: SparkSession) -> Layout:
    return Layout(f"{shared_folder(spark)}/millrace/{uuid4().hex}")


def landing_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of clicks, the ingest run after each and once more."""
    layout = new_layout(spark)
    clicks = sc.clickstream(spark, sf_dir)
    delivered = F.col("pagename") == "view"
    for delivery in (clicks.filter(~delivered), clicks.filter(delivered), None):
        if delivery is not None:
            append_rows(delivery, layout.landing("clickstream"))
        ingest_landing(spark, layout, "clickstream")
    return scan_bronze(spark, layout, "clickstream").select(*sc.CLICK_IDS, "hit_time_gmt")


def recursive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in day folders, read without the folder names."""
    path = new_layout(spark).table("bronze", "clickstream")
    overwrite_table(sc.clickstream(spark, sf_dir), path, by="utc_date")
    return scan_recursive(spark, path).select("hitid_high", "hitid_low", "hit_time_gmt")


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver clicks, the last days written wrongly at first and then replaced twice."""
    path = new_layout(spark).table("silver", "clickstream")
    clicks = silver_clickstream(sc.clickstream(spark, sf_dir), RUN_AT)
    redone = F.col("date") >= F.lit(SPLIT)
    wrong = F.when(redone, -F.col("hitid_low")).otherwise(F.col("hitid_low"))
    overwrite_table(clicks.withColumn("hitid_low", wrong), path, by="date")
    for _ in range(2):
        replace_partitions(clicks.filter(redone), path)
    return scan_table(spark, path).select("hitid_high", "hitid_low", "hit_gmt_timestamp", "date")


def repair_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze clicks after the incomplete delivery was checked and repaired."""
    layout = new_layout(spark)
    attempt = layout.attempt("clickstream", RUN_AT)
    overwrite_table(sc.clicks_base(spark, sf_dir), layout.ranged("clickstream"), by="utc_date")
    overwrite_table(sc.clicks_attempt(spark, sf_dir), attempt)
    repair_clickstream(spark, layout, sc.control_totals(spark, sf_dir), *sc.CLICK_DAYS, RUN_AT,
                       [attempt])
    return scan_bronze(spark, layout, "clickstream").select(*sc.CLICK_IDS)


def both_ingests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries of clicks loaded by date range and by stream: each file and day is in bronze once."""
    layout = new_layout(spark)
    clicks = sc.clickstream(spark, sf_dir)
    first = F.col("pagename") == "view"
    append_rows(clicks.filter(first), layout.landing("clickstream"))
    ingest_range(spark, layout, "clickstream", date(2024, 1, 1), date(2024, 1, 15))
    append_rows(clicks.filter(~first), layout.landing("clickstream"))
    ingest_landing(spark, layout, "clickstream")
    ingest_range(spark, layout, "clickstream", date(2024, 1, 10), date(2024, 1, 30))
    return scan_bronze(spark, layout, "clickstream").select(*sc.CLICK_IDS, "hit_time_gmt")


def snapshot_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales after products were delivered three times: at twice the price, all but one brand again, and that once more."""
    layout = new_layout(spark)
    products = sc.products(spark, sf_dir)
    dearer = products.withColumn("price", (F.col("price") * 2).cast(MONEY))
    for delivery in (dearer, products.filter("product_id <> 'Brand#1'"), products.filter("product_id <> 'Brand#1'")):
        append_rows(delivery, layout.landing("products"))
        ingest_snapshot(spark, layout, "products")
    known = require_unique(scan_table(spark, layout.table("bronze", "products")), "product_id")
    return (silver_transactions(sc.transactions(spark, sf_dir), broadcast_if_small(known))
            .select("order_id", "product_id", "product_name", "price"))


def click_runs(spark: SparkSession, sf_dir: str, deliveries: list[DataFrame], refetch: DataFrame | None = None) -> DataFrame:
    """Silver clicks after one run per delivery, a day apart, and one more where there is a refetch."""
    layout = new_layout(spark)
    control, attempts, at = sc.control_totals(spark, sf_dir), [], RUN_AT
    for delivery in deliveries:
        append_rows(delivery, layout.landing("clickstream"))
        run_pipeline(spark, PipelineConfig(layout, at, control=control))
        at += timedelta(days=1)
    if refetch is not None:
        attempts.append(layout.attempt("clickstream", at))
        overwrite_table(refetch, attempts[0])
        run_pipeline(spark, PipelineConfig(layout, at, control=control, attempts=attempts))
    return scan_table(spark, layout.table("silver", "clickstream")).select(
        "hitid_high", "hitid_low", "visid_high", "visid_low", "hit_gmt_timestamp", "date")


def repair_reaches_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incomplete delivery is loaded; the refetch of a later run completes bronze, silver and all."""
    return click_runs(spark, sf_dir, [sc.clicks_base(spark, sf_dir)], sc.clicks_attempt(spark, sf_dir))


def late_days_reach_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries of the same days, a run after each."""
    clicks, late = sc.clickstream(spark, sf_dir), F.col("pagename") == "view"
    return click_runs(spark, sf_dir, [clicks.filter(~late), clicks.filter(late)])


def column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions delivered with all columns, without one, and with one more: what the footers tell."""
    layout = new_layout(spark)
    rows, day = sc.transactions(spark, sf_dir), F.col("utc_date")
    without, more = date(1998, 1, 1), date(2000, 1, 1)
    for delivery in (rows.filter(day < F.lit(without)),
                     rows.filter((day >= F.lit(without)) & (day < F.lit(more))).drop("email"),
                     rows.filter(day >= F.lit(more)).withColumn("channel", F.lit("web"))):
        append_rows(delivery, layout.landing("transactions"))
    check_delivered_columns(spark, layout, "transactions", RUN_AT)
    files = scan_table(spark, columns_path(layout, "transactions", RUN_AT))
    return (files.groupBy(F.array_join("missing", ",").alias("missing"), F.array_join("extra", ",").alias("extra"),
                          "all_cols_check").agg(F.sum("rows").alias("n_rows")).filter("n_rows > 0"))


def transaction_checks_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a range of days from kept counts; the days arrive in two deliveries, checked after each."""
    layout = new_layout(spark)
    rows, later = sc.tx_dirty(spark, sf_dir), F.col("utc_date") >= F.lit(date(2001, 1, 1))
    for n, delivery in enumerate((rows.filter(later), rows.filter(~later))):
        append_rows(delivery, layout.landing("transactions"))
        ingest_landing(spark, layout, "transactions")
        summarise_days(spark, layout, RUN_AT + timedelta(hours=n))
    return transaction_checks_between(spark, layout, date(2000, 6, 1), date(2001, 7, 15))


def qa_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness of every day of three years from kept counts, the days delivered in two parts."""
    layout = new_layout(spark)
    clicks, late = sc.clicks_3y(spark, sf_dir), F.col("pagename") == "error"
    for n, delivery in enumerate((clicks.filter(~late), clicks.filter(late))):
        append_rows(delivery, layout.landing("clickstream"))
        ingest_landing(spark, layout, "clickstream")
        counts_of_days(spark, layout, RUN_AT + timedelta(hours=n))
    return check_history(spark, layout, sc.control_totals_of(clicks))


def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report at the end of a whole run: landing, checks, silver, gold."""
    layout = new_layout(spark)
    for name, rows in (("users", sc.users), ("products", sc.products),
                       ("clickstream", sc.clickstream)):
        append_rows(rows(spark, sf_dir), layout.landing(name))
    append_rows(sc.transactions(spark, sf_dir).hint("rebalance", "utc_date"),
                layout.landing("transactions"))
    config = PipelineConfig(layout, RUN_AT, control=sc.control_totals(spark, sf_dir))
    return run_pipeline(spark, config)


WRITTEN = {query.__name__: query for query in (
    landing_ingest, recursive_scan, partition_replace, repair_run, both_ingests, snapshot_redelivered,
    repair_reaches_silver, late_days_reach_silver, column_check, transaction_checks_range, qa_history,
    medallion_run)}
