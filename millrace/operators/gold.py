"""Silver to gold: daily signed sales per customer and product, with the previous entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.expressions import MONEY, adjusted_signed_price, signed_price

GOLD_COLUMNS = ("email", "product_id", "date", "year", "month", "transaction_type",
                "daily_signed_price", "previous_purchase_signed_price")


def with_signed_price(silver: DataFrame) -> DataFrame:
    return silver.withColumn("signed_price", signed_price())


def gold_daily_signed(silver: DataFrame) -> DataFrame:
    """Sum of signed prices per customer, product, day and transaction type.

    Year and month follow from the date, so they are added after the aggregation and do not
    widen the shuffle.
    """
    return (with_signed_price(silver)
            .groupBy("email", "product_id", "date", "transaction_type")
            .agg(F.sum("signed_price").cast(MONEY).alias("daily_signed_price"))
            .select("email", "product_id", "date", F.year("date").alias("year"),
                    F.month("date").alias("month"), "transaction_type", "daily_signed_price"))


def with_previous(daily: DataFrame) -> DataFrame:
    """Daily signed price of the customer's previous entry for the same product.

    A window group holds at most one row per day and transaction type: a customer-product pair
    that owns a third of all sales was already collapsed to that by the daily aggregation.
    Transaction type breaks the tie of a purchase and a return on one day.
    """
    history = (Window.partitionBy("email", "product_id")
               .orderBy("date", "transaction_type"))
    return daily.withColumn("previous_purchase_signed_price",
                            F.lag("daily_signed_price").over(history))


def gold_transactions(silver: DataFrame) -> DataFrame:
    return with_previous(gold_daily_signed(silver))


def gold_since(silver_new: DataFrame, gold_before: DataFrame) -> DataFrame:
    """Gold rows of the days in ``silver_new``, continuing from ``gold_before``.

    ``silver_new`` holds all silver rows from some day on, ``gold_before`` all gold rows before
    that day; only the last entry of each customer-product pair is used of it.
    """
    return gold_after(gold_daily_signed(silver_new), last_entries(gold_before))


# Columns of a last entry; the order decides which of two entries is the later.
ENTRY = ("date", "transaction_type", "daily_signed_price")


def last_entries(gold: DataFrame) -> DataFrame:
    """The last entry of every customer and product, one row each."""
    return (gold.groupBy("email", "product_id").agg(F.max(F.struct(*ENTRY)).alias("entry"))
            .select("email", "product_id", "entry.*"))


def merged_entries(last: DataFrame, new: DataFrame) -> DataFrame:
    """Last entries of two tables of gold rows or last entries; it is the same operation."""
    columns = ["email", "product_id", *ENTRY]
    return last_entries(last.select(*columns).unionByName(new.select(*columns)))


def gold_after(daily: DataFrame, last: DataFrame) -> DataFrame:
    """Gold rows of new days (``gold_daily_signed``), continuing from the last entries before them.

    Entries of pairs that do not occur in the new days leave the plan at the semi join.
    """
    touched = daily.select(F.col("email").alias("t_email"), F.col("product_id").alias("t_product_id")).distinct()
    entries = (last.join(touched, F.col("email").eqNullSafe(F.col("t_email"))
                         & F.col("product_id").eqNullSafe(F.col("t_product_id")), "left_semi")
               .select("email", "product_id", "date", F.year("date").alias("year"), F.month("date").alias("month"),
                       "transaction_type", "daily_signed_price", F.lit(False).alias("_new")))
    both = daily.withColumn("_new", F.lit(True)).unionByName(entries)
    return with_previous(both).filter("_new").drop("_new")


def with_adjusted_price(gold: DataFrame) -> DataFrame:
    return gold.withColumn("adjusted_signed_price", adjusted_signed_price())
