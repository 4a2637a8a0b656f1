"""The change log of bronze: which feed brought which days from which file.

Every writer of bronze rows (stream, date range, repair) records a part after it wrote: one row per
file and day. A part that is written again replaces its entry, with a new time. Consumers
(silver, day counts, transaction checks) remember the parts they have taken in; days of other parts are
what they still have to do, whatever their dates and whoever wrote them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.layout import Layout
from millrace.sources.sinks import append_rows, overwrite_table
from millrace.sources.tables import ABSENT_CONDITIONS, scan_bronze

CHANGES = "feed string, part string, recorded_at timestamp, file string, utc_date date, rows bigint"
TAKEN = "feed string, part string, recorded_at timestamp"
PART = ("feed", "part", "recorded_at")
#: Column that carries the delivered file of a row until it is written.
FILE = "_file"
LANDED, RANGED, REPAIRED, ADOPTED = "landed", "ranged", "repaired", "adopted"


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A log with a fixed schema; None where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ABSENT_CONDITIONS:
            return None
        raise


def changes(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    return read_log(spark, layout.changes(name), CHANGES)


def record_changes(rows: DataFrame, layout: Layout, name: str, feed: str, part: str) -> None:
    """Count rows per file (``FILE``, null where there is none) and day; only these columns are read."""
    at = F.lit(datetime.now(timezone.utc))
    counted = rows.groupBy(FILE, "utc_date").agg(F.count("*").alias("rows"))
    overwrite_table(counted.select(at.alias("recorded_at"), F.col(FILE).alias("file"), "utc_date", "rows"),
                    f"{layout.changes(name)}/feed={feed}/part={part}")


def with_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def without_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FILE, F.lit(None).cast("string"))


def adopt_bronze(spark: SparkSession, layout: Layout, name: str) -> None:
    """Bronze rows written before there was a log become its first part."""
    if changes(spark, layout, name) is not None:
        return
    try:
        bronze = scan_bronze(spark, layout, name)
    except FileNotFoundError:
        return
    record_changes(without_file(bronze.select("utc_date")), layout, name, ADOPTED, "0")


def not_loaded_by(feed: str, rows: DataFrame, layout: Layout, name: str) -> DataFrame:
    """Rows (with ``FILE``) of files and days that another feed has not brought to bronze."""
    log = changes(rows.sparkSession, layout, name)
    if log is None:
        return rows
    held = log.filter(F.col("feed") == feed).select(F.col("file").alias("held"), F.col("utc_date").alias("day")).distinct()
    if held.isEmpty():
        return rows
    return rows.join(held, (F.col(FILE) == F.col("held")) & F.col("utc_date").eqNullSafe(F.col("day")), "left_anti")


def pending(spark: SparkSession, layout: Layout, name: str, consumer: str) -> DataFrame:
    """Log rows of the parts the consumer has not taken in."""
    log = changes(spark, layout, name)
    if log is None:
        return spark.createDataFrame([], CHANGES)
    taken = read_log(spark, layout.taken(name, consumer), TAKEN)
    return log if taken is None else log.join(taken.distinct(), list(PART), "left_anti")


def parts_of(log: DataFrame) -> list[tuple]:
    """Parts of a log: one per batch, range or repair run, not per file."""
    return [tuple(row) for row in log.select(*PART).distinct().collect()]


def days_of(log: DataFrame) -> list[date | None]:
    return [row["utc_date"] for row in log.select("utc_date").distinct().collect()]


def take(spark: SparkSession, layout: Layout, name: str, consumer: str, parts: Iterable[tuple]) -> None:
    """Remember that the consumer has taken these parts in."""
    parts = list(parts)
    if parts:
        append_rows(spark.createDataFrame(parts, TAKEN).coalesce(1), layout.taken(name, consumer))


def on_days(rows: DataFrame, days: Iterable[date | None], column: str = "utc_date") -> DataFrame:
    """Rows of the given days. Days are literals, so folders of others are pruned while planning."""
    days = list(days)
    chosen = F.col(column).isin([day for day in days if day is not None])
    return rows.filter(chosen | F.col(column).isNull() if None in days else chosen)
