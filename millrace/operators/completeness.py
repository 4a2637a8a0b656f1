"""Are all clicks there? Distinct hits and visitors per day against expected totals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import RATE, rate_literal, rounded_ratio
from millrace.operators.incremental import within_dates

# Share of expected hits and visitors a day needs, and failing days allowed.
THRESHOLD = 0.99
MAX_FAILING_DAYS = 1

DAILY_COLUMNS = ("utc_date", "hits_num", "visitors_num", "num_of_hitid", "num_of_visid",
                 "hit_completeness", "visitors_completeness", "reach_threshold")


def daily_visitors_hits(clicks: DataFrame) -> DataFrame:
    """Exact distinct visitors and hits per day.

    Both counts come from one scan. Spark shuffles by (day, id) first and by day only after
    the ids are counted, so a day that holds a third of the clicks is still spread out.
    A pair with a NULL half is not counted.
    """
    return clicks.groupBy("utc_date").agg(
        F.countDistinct("visid_high", "visid_low").alias("num_of_visid"),
        F.countDistinct("hitid_high", "hitid_low").alias("num_of_hitid"),
    )


def control_totals_spine(control: DataFrame, start: date, end: date) -> DataFrame:
    """Expected totals for every day of ``[start, end]``; 0 where none are known."""
    days = control.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end))).alias("utc_date"))
    expected = within_dates(control, start, end).select("utc_date", "hits_num", "visitors_num")
    return days.join(expected, "utc_date", "left").fillna(0, ["hits_num", "visitors_num"])


def completeness_daily(clicks: DataFrame, control: DataFrame, start: date, end: date,
                       threshold: float = THRESHOLD) -> DataFrame:
    """Expected and actual totals per day, both rates, and whether both reach the threshold."""
    return completeness_of_counts(daily_visitors_hits(within_dates(clicks, start, end)), control, start, end,
                                  threshold)


def completeness_of_counts(actual: DataFrame, control: DataFrame, start: date, end: date,
                           threshold: float = THRESHOLD) -> DataFrame:
    """As ``completeness_daily``, from distinct counts per day that are already there."""
    hit_rate = rounded_ratio(F.col("num_of_hitid"), F.col("hits_num"), 4).cast(RATE)
    visitor_rate = rounded_ratio(F.col("num_of_visid"), F.col("visitors_num"), 4).cast(RATE)
    needed = rate_literal(threshold)
    reached = (F.col("hit_completeness") >= needed) & (F.col("visitors_completeness") >= needed)
    return (control_totals_spine(control, start, end)
            .join(actual, "utc_date", "left")
            .fillna(0, ["num_of_hitid", "num_of_visid"])
            .withColumns({"hit_completeness": hit_rate, "visitors_completeness": visitor_rate})
            .withColumn("reach_threshold", F.coalesce(reached, F.lit(False)))
            .select(*DAILY_COLUMNS))


def completeness_verdict(daily: DataFrame, max_failing_days: int = MAX_FAILING_DAYS) -> DataFrame:
    """One row: how many days fail, and whether that is tolerated."""
    failing = F.count_if(~F.col("reach_threshold"))
    return daily.agg(failing.alias("failing_days"),
                     (failing <= max_failing_days).alias("complete"))


def completeness_by_year(clicks: DataFrame, control: DataFrame, start: date, end: date,
                         threshold: float = THRESHOLD,
                         max_failing_days: int = MAX_FAILING_DAYS) -> DataFrame:
    """The verdict per calendar year of the range, all years in one job."""
    return verdicts_by_year(completeness_daily(clicks, control, start, end, threshold), max_failing_days)


def verdicts_by_year(daily: DataFrame, max_failing_days: int = MAX_FAILING_DAYS) -> DataFrame:
    failing = F.count_if(~F.col("reach_threshold"))
    return (daily.groupBy(F.year("utc_date").alias("year"))
            .agg(F.count("*").alias("days"), failing.alias("failing_days"),
                 (failing <= max_failing_days).alias("complete")))
