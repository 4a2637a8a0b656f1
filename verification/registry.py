"""One entry per operator: a callable ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import (
    completeness, gold, incremental, repair, report, silver, transaction_checks,
)
from millrace.operators.lookups import broadcast_if_small
from verification import scenarios as sc
from verification.written import WRITTEN

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = broadcast_if_small(sc.products(spark, sf_dir))
    return (silver.silver_transactions(sc.transactions(spark, sf_dir), products)
            .drop("etl_loaded_at"))


def gold_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.gold_transactions(silver_of(spark, sf_dir))


def click_ids(clicks: DataFrame) -> DataFrame:
    return clicks.select(*sc.CLICK_IDS)


def merged_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.merge_attempts(click_ids(sc.clicks_base(spark, sf_dir)),
                                 click_ids(sc.clicks_attempt(spark, sf_dir)),
                                 start=sc.CLICK_DAYS[0], end=sc.CLICK_DAYS[1])


def gathered_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.gather_attempts(sc.clicks_base(spark, sf_dir), sc.clicks_attempt(spark, sf_dir),
                                  start=sc.CLICK_DAYS[0], end=sc.CLICK_DAYS[1])


@register
def scan_table(spark, sf_dir):
    return sc.read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.col("o_orderdate").cast("date").alias("utc_date"))


@register
def control_totals_spine(spark, sf_dir):
    return completeness.control_totals_spine(sc.control_totals_gap(spark, sf_dir), *sc.CLICK_DAYS)


@register
def explode_items(spark, sf_dir):
    return silver.explode_items(sc.transactions(spark, sf_dir)).select("order_id", "product_id")


@register
def incremental_filter(spark, sf_dir):
    mark = incremental.high_watermark(sc.silver_target(spark, sf_dir))
    return (incremental.after_watermark(sc.transactions(spark, sf_dir), mark)
            .select("order_id", "transaction_type", "utc_date"))


@register
def late_rows(spark, sf_dir):
    return incremental.late_rows(sc.transactions(spark, sf_dir), sc.silver_target(spark, sf_dir))


@register
def late_rows_of_batch(spark, sf_dir):
    return incremental.late_rows_of(sc.transactions(spark, sf_dir), sc.silver_target(spark, sf_dir))


@register
def high_watermark(spark, sf_dir):
    return incremental.high_watermark(sc.transactions(spark, sf_dir), "utc_date")


@register
def ingest_range(spark, sf_dir):
    return incremental.ingest_range(sc.transactions(spark, sf_dir), as_of=date(2001, 9, 1), column="utc_date")


@register
def date_bounds(spark, sf_dir):
    return incremental.date_bounds(sc.clickstream(spark, sf_dir))


@register
def date_range_filter(spark, sf_dir):
    return (incremental.within_dates(sc.clickstream(spark, sf_dir),
                                     date(2024, 1, 10), date(2024, 1, 20))
            .select("hitid_high", "hitid_low", "utc_date"))


@register
def silver_users(spark, sf_dir):
    return silver.silver_users(sc.users(spark, sf_dir)).drop("etl_loaded_at")


@register
def silver_products(spark, sf_dir):
    return silver.silver_products(sc.all_products(spark, sf_dir)).drop("etl_loaded_at")


@register
def load_time(spark, sf_dir):
    users = silver.silver_users(sc.users(spark, sf_dir), loaded_at=datetime(2024, 2, 1, 12))
    return users.select("account_id", F.col("etl_loaded_at").cast("string").alias("etl_loaded_at"))


@register
def silver_transactions(spark, sf_dir):
    return silver_of(spark, sf_dir)


@register
def silver_clickstream(spark, sf_dir):
    return silver.silver_clickstream(sc.clickstream(spark, sf_dir)).drop("etl_loaded_at")


@register
def signed_price(spark, sf_dir):
    return gold.with_signed_price(silver_of(spark, sf_dir)).select(
        "order_id", "product_id", "date", "transaction_type", "price", "signed_price")


@register
def gold_daily_signed(spark, sf_dir):
    return gold.gold_daily_signed(silver_of(spark, sf_dir))


@register
def gold_transactions(spark, sf_dir):
    return gold_of(spark, sf_dir)


@register
def gold_continued(spark, sf_dir):
    """Gold up to 2000, and from 2001 on continued from it as the incremental load does."""
    sales, split = silver_of(spark, sf_dir), F.lit(date(2001, 1, 1))
    before = gold.gold_transactions(sales.filter(F.col("date") < split))
    return before.unionByName(gold.gold_since(sales.filter(F.col("date") >= split), before))


@register
def last_entries(spark, sf_dir):
    """Last entries up to 2000, brought up to date with the gold rows of later days."""
    rows, split = gold_of(spark, sf_dir), F.lit(date(2001, 1, 1))
    before = gold.last_entries(rows.filter(F.col("date") < split))
    return gold.merged_entries(before, rows.filter(F.col("date") >= split))


@register
def adjusted_signed_price(spark, sf_dir):
    return gold.with_adjusted_price(gold_of(spark, sf_dir))


@register
def complete_months(spark, sf_dir):
    return (report.complete_months(gold_of(spark, sf_dir), whole=silver_of(spark, sf_dir))
            .select("email", "product_id", "date", "transaction_type"))


@register
def monthly_sales(spark, sf_dir):
    return report.monthly_sales(report.complete_months(gold_of(spark, sf_dir), whole=silver_of(spark, sf_dir)))


@register
def mom_growth(spark, sf_dir):
    return report.mom_growth(monthly_sales(spark, sf_dir))


@register
def report_one_product(spark, sf_dir):
    return report.sales_report(gold_of(spark, sf_dir), sc.products(spark, sf_dir),
                               product_id="Brand#1", whole=silver_of(spark, sf_dir))


@register
def report_all_products(spark, sf_dir):
    return report.sales_report(gold_of(spark, sf_dir), sc.products(spark, sf_dir),
                               whole=silver_of(spark, sf_dir))


@register
def daily_visitors_hits(spark, sf_dir):
    return completeness.daily_visitors_hits(sc.clickstream(spark, sf_dir))


@register
def completeness_daily(spark, sf_dir):
    return completeness.completeness_daily(
        sc.clicks_base(spark, sf_dir), sc.control_totals_gap(spark, sf_dir), *sc.CLICK_DAYS)


@register
def completeness_verdict(spark, sf_dir):
    daily = completeness.completeness_daily(
        gathered_clicks(spark, sf_dir), sc.control_totals(spark, sf_dir), *sc.CLICK_DAYS)
    return completeness.completeness_verdict(daily)


@register
def completeness_by_year(spark, sf_dir):
    clicks = sc.clicks_3y(spark, sf_dir)
    return completeness.completeness_by_year(clicks, sc.control_totals_of(clicks), *sc.CLICK_YEARS)


@register
def merge_attempts(spark, sf_dir):
    return merged_clicks(spark, sf_dir)


@register
def repair_delta(spark, sf_dir):
    return repair.repair_delta(merged_clicks(spark, sf_dir),
                               click_ids(sc.clicks_base(spark, sf_dir)))


@register
def qa_repair_log(spark, sf_dir):
    control = sc.control_totals(spark, sf_dir)
    initial = completeness.completeness_daily(
        sc.clicks_base(spark, sf_dir), control, *sc.CLICK_DAYS)
    final = completeness.completeness_daily(
        gathered_clicks(spark, sf_dir), control, *sc.CLICK_DAYS)
    return repair.qa_repair_log(initial, final)


@register
def null_rows(spark, sf_dir):
    return (transaction_checks.null_rows(sc.tx_dirty(spark, sf_dir))
            .select("order_id", "transaction_type", "utc_date"))


@register
def duplicate_rows(spark, sf_dir):
    return (transaction_checks.duplicate_rows(sc.tx_dirty(spark, sf_dir))
            .select("order_id", "transaction_type", "n_dup"))


@register
def day_checks(spark, sf_dir):
    return transaction_checks.day_checks(sc.tx_dirty(spark, sf_dir))


def check_row(spark, sf_dir):
    return transaction_checks.transaction_checks(sc.tx_dirty(spark, sf_dir))


REGISTRY["transaction_checks"] = check_row
REGISTRY.update(WRITTEN)
