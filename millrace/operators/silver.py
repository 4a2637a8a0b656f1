"""Bronze to silver: select, rename, convert epoch seconds, enrich with products."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import MONEY, utc_string

# Columns of the cleaned clickstream table, in order.
SILVER_CLICKSTREAM_COLUMNS = (
    "campaign", "currency", "cust_hit_gmt_timestamp", "cust_visid", "event_list",
    "first_hit_gmt_timestamp", "hit_gmt_timestamp", "hitid_high", "hitid_low", "os",
    "page_url", "pagename", "product_list", "visid_high", "visid_low",
    "visit_start_gmt_timestamp", "evar1", "evar2", "evar3", "evar4", "evar5", "evar6",
    "etl_loaded_at", "date",
)


def load_time(loaded_at: datetime | None) -> Column:
    """The given load time, or the time the query runs."""
    return F.current_timestamp() if loaded_at is None else F.lit(loaded_at)


def silver_users(users: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return users.select(
        "account_id", "email",
        utc_string("first_time_time_stamp").alias("first_timestamp"),
        load_time(loaded_at).alias("etl_loaded_at"),
    )


def silver_products(products: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return products.withColumn("etl_loaded_at", load_time(loaded_at))


def explode_items(transactions: DataFrame) -> DataFrame:
    """One row per item of an order; orders without items give none."""
    return transactions.withColumn("product_id", F.explode("items"))


def silver_transactions(transactions: DataFrame, products: DataFrame,
                        loaded_at: datetime | None = None) -> DataFrame:
    """One row per sold or returned item with name and price; unknown products drop out.

    Pass ``products`` through ``broadcast_if_small`` to join without shuffling the items.
    """
    priced = products.select("product_id", "product_name", F.col("price").cast(MONEY).alias("price"))
    # Fixed values below: columns of the cleaned transactions table, in order.
    return (explode_items(transactions)
            .join(priced, "product_id")
            .select("order_id", "email",
                    utc_string("transaction_timestamp").alias("transaction_utc_timestamp"),
                    "transaction_type", "product_name", "product_id", "price",
                    load_time(loaded_at).alias("etl_loaded_at"),
                    F.to_date("utc_date").alias("date")))


def silver_clickstream(clicks: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return clicks.withColumns({
        "cust_hit_gmt_timestamp": utc_string("cust_hit_time_gmt"),
        "first_hit_gmt_timestamp": utc_string("first_hit_time_gmt"),
        "hit_gmt_timestamp": utc_string("hit_time_gmt"),
        "visit_start_gmt_timestamp": utc_string("visit_start_time_gmt"),
        "etl_loaded_at": load_time(loaded_at),
        "date": F.to_date("utc_date"),
    }).select(*SILVER_CLICKSTREAM_COLUMNS)
