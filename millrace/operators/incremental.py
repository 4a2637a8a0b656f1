"""What is new: watermarks, date ranges and rows that arrived too late."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.sets import rows_absent_from


def high_watermark(target: DataFrame, column: str = "date") -> DataFrame:
    """One row ``max_date``; NULL for an empty target."""
    return target.agg(F.max(column).alias("max_date"))


def date_bounds(df: DataFrame, column: str = "utc_date") -> DataFrame:
    """One row ``min_date, max_date`` from one pass."""
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def after_watermark(source: DataFrame, watermark: DataFrame | date | None,
                    column: str = "utc_date") -> DataFrame:
    """Rows strictly after the watermark; all rows where there is none yet.

    A date is a literal and prunes partition folders while planning. A one-row frame
    (``high_watermark``) stays lazy: a scalar subquery, run once, pruning at run time.
    """
    if watermark is None:
        return source
    if isinstance(watermark, DataFrame):
        mark = watermark.scalar()
        return source.filter(mark.isNull() | (F.col(column) > mark))
    return source.filter(F.col(column) > F.lit(watermark))


def within_dates(df: DataFrame, start: date, end: date, column: str = "utc_date") -> DataFrame:
    """Rows of the closed range ``[start, end]``."""
    return df.filter(F.col(column).between(F.lit(start), F.lit(end)))


def late_rows(source: DataFrame, target: DataFrame, keys: tuple[str, ...] = ("order_id",),
              source_date: str = "utc_date", target_date: str = "date") -> DataFrame:
    """Keys and dates at or before the target's watermark that the target does not hold.

    ``after_watermark`` never loads these. One row per distinct key and date.
    """
    mark = high_watermark(target, target_date).scalar()
    seen = source.filter(F.col(source_date) <= mark).select(*keys, source_date)
    held = target.select(*keys, F.col(target_date).alias(source_date))
    return rows_absent_from(seen, held)


def late_rows_of(batch: DataFrame, target: DataFrame, watermark: date | None = None,
                 keys: tuple[str, ...] = ("order_id",), source_date: str = "utc_date",
                 target_date: str = "date") -> DataFrame:
    """``late_rows`` of a newly delivered batch, reading only the target's days that the batch touches.

    The batch's days prune the target's folders at run time; they are broadcast, as a batch has at most
    one per calendar day. Without a ``watermark`` from the run state it is the target's own.
    """
    mark = high_watermark(target, target_date).scalar() if watermark is None else F.lit(watermark)
    seen = batch.filter(F.col(source_date) <= mark).select(*keys, source_date)
    held = target.select(*keys, F.col(target_date).alias(source_date))
    days = seen.select(source_date).distinct()
    return rows_absent_from(seen, held.join(F.broadcast(days), source_date, "left_semi"))


def ingest_range(target: DataFrame, as_of: date, column: str = "date") -> DataFrame:
    """The next range to fetch, ``[watermark + 1, as_of - 1]``, and its first year.

    No row when the target is up to date; a NULL start for an empty target (fetch everything).
    """
    start = F.date_add("max_date", 1)
    end = F.date_sub(F.lit(as_of), 1)
    return (high_watermark(target, column)
            .select(start.alias("start_date"), end.alias("end_date"),
                    F.year(start).alias("year"))
            .filter(F.col("start_date").isNull()
                    | (F.col("start_date") <= F.col("end_date"))))
