"""The given star-schema tables in the shape of the bronze tables, and derived scenarios.

Nothing here picks rows by id: scenarios with missing, late or repeated rows are cut by what a
delivery would lose or repeat (an event type, a priority, a month). ``FIXTURES.md`` has the
definitions, ``verification/oracle.py`` the same in SQL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.expressions import MONEY
from millrace.sources.tables import scan_table

CLICK_DAYS = (date(2024, 1, 1), date(2024, 1, 30))
CLICK_YEARS = (date(2024, 1, 1), date(2026, 1, 30))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts: str) -> Column:
    """Whole epoch seconds of a zone-less timestamp read as UTC."""
    return (F.unix_date(F.col(ts).cast("date")).cast("bigint") * 86400
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def email_of(name: str) -> Column:
    return F.concat(F.col(name), F.lit("@example.com"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("account_id"),
        email_of("c_name").alias("email"),
        (F.lit(1577836800).cast("bigint") + F.col("c_custkey") * 3600)
        .alias("first_time_time_stamp"))


def all_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read(spark, sf_dir, "part")
            .groupBy(F.col("p_brand").alias("product_id"))
            .agg(F.min("p_retailprice").cast(MONEY).alias("price"))
            .select("product_id", F.concat(F.lit("Product "), "product_id").alias("product_name"),
                    "price"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup of sales: one brand is unknown to it."""
    return all_products(spark, sf_dir).filter(F.col("product_id") != "Brand#25")


def transactions_of(spark: SparkSession, sf_dir: str, orders: DataFrame,
                    email: Column | None = None) -> DataFrame:
    """Transactions of the given orders: one per order and type, items in line order.

    Lines are brought together by order before they are grouped: the groups are small, so
    collecting them on the map side first would only add a second pass.
    """
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    brands = read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    customers = read(spark, sf_dir, "customer")
    kind = F.when(F.col("l_returnflag") == "R", "return").otherwise("purchase")
    line = F.struct("l_linenumber", "l_partkey", "p_brand")
    baskets = (lines.join(brands, F.col("l_partkey") == F.col("p_partkey"))
               .repartition("l_orderkey")
               .groupBy("l_orderkey", kind.alias("transaction_type"))
               .agg(F.array_sort(F.collect_list(line)).alias("lines"),
                    F.count("*").cast("int").alias("total_item_quantity"),
                    F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY)
                    .alias("total_purchase_usd")))
    return (baskets.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .select((email_of("c_name") if email is None else email).alias("email"),
                    F.col("lines.p_brand").alias("items"),
                    F.concat_ws("-", F.col("o_orderkey").cast("string"), "transaction_type")
                    .alias("order_id"),
                    "total_item_quantity", "total_purchase_usd",
                    epoch_seconds("o_orderdate").alias("transaction_timestamp"),
                    "transaction_type",
                    F.col("o_orderdate").cast("date").alias("utc_date")))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_of(spark, sf_dir, read(spark, sf_dir, "orders"))


def silver_target_orders(orders: DataFrame) -> DataFrame:
    """Orders up to 30 June 2001, without the urgent ones of June: those came late."""
    ordered = F.col("o_orderdate").cast("date")
    late = (ordered >= F.lit(date(2001, 6, 1))) & (F.col("o_orderpriority") == "1-URGENT")
    return orders.filter((ordered <= F.lit(date(2001, 6, 30))) & ~late)


def silver_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = silver_target_orders(read(spark, sf_dir, "orders"))
    return transactions_of(spark, sf_dir, orders).withColumnRenamed("utc_date", "date")


def tx_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No email for accounts in arrears; transactions from July 2001 on delivered twice."""
    email = F.when(F.col("c_acctbal") >= 0, email_of("c_name"))
    delivered = transactions_of(spark, sf_dir, read(spark, sf_dir, "orders"), email)
    copies = (F.when(F.col("utc_date") >= F.lit(date(2001, 7, 1)), F.array(F.lit(1), F.lit(2)))
              .otherwise(F.array(F.lit(1))))
    return delivered.withColumn("copy", F.explode(copies)).drop("copy")


def clickstream_of(events: DataFrame) -> DataFrame:
    hit = epoch_seconds("ts")
    none = F.lit(None).cast("string")
    return events.select(
        none.alias("campaign"), F.lit("USD").alias("currency"),
        hit.alias("cust_hit_time_gmt"), none.alias("cust_visid"),
        F.col("props").alias("event_list"), (hit - 60).alias("first_hit_time_gmt"),
        hit.alias("hit_time_gmt"),
        F.expr("event_id div 100").alias("hitid_high"),
        (F.col("event_id") % 100).alias("hitid_low"),
        none.alias("os"), none.alias("page_url"), F.col("event_type").alias("pagename"),
        none.alias("product_list"),
        F.expr("user_id div 16").alias("visid_high"), (F.col("user_id") % 16).alias("visid_low"),
        (hit - 600).alias("visit_start_time_gmt"),
        *[none.alias(f"evar{n}") for n in range(1, 7)],
        F.col("ts").cast("date").alias("utc_date"))


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clickstream_of(read(spark, sf_dir, "events"))


def clicks_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First delivery: the collector of one event type was down."""
    return clickstream_of(read(spark, sf_dir, "events").filter(F.col("event_type") != "error"))


def clicks_attempt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refetch: the missing type and one already delivered; one day is still missing."""
    still_missing = ((F.col("event_type") == "error")
                     & (F.col("ts").cast("date") == F.lit(date(2024, 1, 15))))
    return clickstream_of(read(spark, sf_dir, "events")
                          .filter(F.col("event_type").isin("error", "click") & ~still_missing))


CLICK_IDS = ("hitid_high", "hitid_low", "visid_high", "visid_low", "utc_date")


def control_totals_of(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy("utc_date").agg(
        F.count("*").alias("hits_num"),
        F.countDistinct("visid_high", "visid_low").alias("visitors_num"))


def control_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return control_totals_of(clickstream(spark, sf_dir))


def control_totals_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals without 3 January, and with no hits expected on 4 January."""
    no_hits = F.col("utc_date") == F.lit(date(2024, 1, 4))
    return (control_totals(spark, sf_dir)
            .filter(F.col("utc_date") != F.lit(date(2024, 1, 3)))
            .withColumn("hits_num", F.when(no_hits, F.lit(0)).otherwise(F.col("hits_num"))))


def clicks_3y(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks moved on by a year or two, depending on the event type."""
    years = (F.when(F.col("pagename") == "click", 1).when(F.col("pagename") == "view", 2)
             .otherwise(0))
    return clickstream(spark, sf_dir).withColumn(
        "utc_date", F.add_months("utc_date", years * 12))
