"""Gold to report: monthly sales and their month-over-month growth."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.expressions import (
    MONEY, MONTH_LABELS, month_end_cutoff, month_label, rounded_ratio,
)


def complete_months(gold: DataFrame, as_of: date | None = None,
                    whole: DataFrame | None = None) -> DataFrame:
    """Rows up to the end of the last complete month.

    ``as_of`` is the day data reaches up to; without it, the latest date in ``whole`` (default
    ``gold`` itself) is found by a scalar subquery, which reads the date column only and
    prunes date folders at run time.
    """
    if as_of is not None:
        cutoff = month_end_cutoff(F.lit(as_of))
    else:
        latest = (gold if whole is None else whole).agg(F.max("date").alias("latest"))
        cutoff = latest.select(month_end_cutoff(F.col("latest")).alias("cutoff")).scalar()
    return gold.filter(F.col("date") <= cutoff)


def monthly_sales(gold: DataFrame) -> DataFrame:
    return (gold.groupBy("product_id", "year", "month")
            .agg(F.round(F.sum("daily_signed_price"), 2).cast(MONEY).alias("total_sales")))


def mom_growth(monthly: DataFrame) -> DataFrame:
    """Growth over the previous month present, in money and percent.

    The first month grows by its own total and by 0 percent; so does, in percent, a month
    after a total of 0. A window group is the months of one product.
    """
    months = Window.partitionBy("product_id").orderBy("year", "month")
    total, previous = F.col("total_sales"), F.col("_previous")
    growth = F.round(total - previous, 2)
    return (monthly.withColumn("_previous", F.lag("total_sales").over(months))
            .select("product_id", "year", "month", "total_sales",
                    F.coalesce(growth, total).cast(MONEY).alias("MoM_growth"),
                    F.coalesce(rounded_ratio(growth, previous, 2, factor=100), F.lit(0))
                     .cast(MONEY).alias("MoM_pct_growth")))


def sales_report(gold: DataFrame, products: DataFrame, product_id: str | None = None,
                 as_of: date | None = None, whole: DataFrame | None = None) -> DataFrame:
    """Monthly report of one product, or of all, sorted by product and month.

    ``whole`` is where the latest date is looked up: where ``gold`` is a query and not a table, its
    silver rows have the same dates and spare its aggregations.
    """
    chosen = gold if product_id is None else gold.filter(F.col("product_id") == product_id)
    growth = mom_growth(monthly_sales(complete_months(chosen, as_of, whole=gold if whole is None else whole)))
    return (growth
            .join(products.select("product_id", "product_name"), "product_id", "left")
            .orderBy("product_id", "year", "month")
            .select("product_name", "year", month_label(F.col("month")).alias("aliased_month"),
                    "total_sales", "MoM_growth", "MoM_pct_growth"))


def order_report(report: DataFrame) -> DataFrame:
    """A saved report by product name and month; files keep no order."""
    months = F.array(*[F.lit(name) for name in MONTH_LABELS])
    return report.orderBy("product_name", "year", F.array_position(months, F.col("aliased_month")))
