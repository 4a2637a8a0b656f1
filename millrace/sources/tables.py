"""Table scans."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.layout import Layout

# Error conditions Spark raises when there is no table at a path yet.
ABSENT_CONDITIONS = {
    "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND",
    "DELTA_PATH_DOES_NOT_EXIST",
}


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Current rows of the table at ``path``; ``fmt`` may be any installed source."""
    return spark.read.format(fmt).load(path)


def scan_recursive(spark: SparkSession, root: str) -> DataFrame:
    """Every Parquet file below ``root``; folder names are not read as columns."""
    return spark.read.option("recursiveFileLookup", "true").parquet(root)


def scan_glob(spark: SparkSession, *patterns: str) -> DataFrame:
    """Parquet files matching any of the path patterns."""
    return spark.read.parquet(*patterns)


def scan_refetch(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows delivered to a refetch folder, with the declared schema; none where it is empty."""
    try:
        return (spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/*"))
    except AnalysisException as error:
        if error.getCondition() in ABSENT_CONDITIONS:
            return spark.createDataFrame([], schema)
        raise


def scan_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """``scan_table``, or None where the table has not been written yet."""
    try:
        return scan_table(spark, path, fmt)
    except AnalysisException as error:
        if error.getCondition() in ABSENT_CONDITIONS:
            return None
        raise


def scan_bronze(spark: SparkSession, layout: Layout, name: str,
                without_run: str | None = None) -> DataFrame:
    """All bronze rows of a fact table: landed by stream, by date range, and repaired.

    Each folder is partitioned by ``utc_date``, so a date filter prunes folders in all of them.
    ``without_run`` leaves out what that repair run added, so that it can be run again.
    """
    landed = scan_if_present(spark, layout.landed(name))
    landed = None if landed is None else landed.drop("batch_id")
    ranged = scan_if_present(spark, layout.ranged(name))
    repaired = scan_if_present(spark, layout.repaired(name))
    if repaired is not None:
        if without_run is not None:
            repaired = repaired.filter(F.col("run_id") != without_run)
        repaired = repaired.drop("run_id")
    feeds = [feed for feed in (landed, ranged, repaired) if feed is not None]
    if not feeds:
        raise FileNotFoundError(f"no bronze rows of {name!r} below {layout.table('bronze', name)}")
    return reduce(DataFrame.unionByName, feeds)
