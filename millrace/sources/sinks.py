"""Table writers.

A partitioned write is preceded by ``rebalance`` on the partition column: rows of a day come
together (few files per day), and AQE splits a day that is larger than the advisory partition
size over several tasks, so one hot day is never one task. Where the rows to write were read
from large files of one day each and not shuffled since, ``rebalance=False`` saves that shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter


def partitioned(df: DataFrame, by: str, fmt: str, rebalance: bool = True) -> DataFrameWriter:
    rows = df.hint("rebalance", by) if rebalance else df
    return rows.write.format(fmt).partitionBy(by)


def overwrite_table(df: DataFrame, path: str, fmt: str = "parquet",
                    by: str | None = None) -> None:
    """Replace the whole table."""
    writer = df.write.format(fmt) if by is None else partitioned(df, by, fmt)
    writer.mode("overwrite").option("partitionOverwriteMode", "static").save(path)


def append_partitions(df: DataFrame, path: str, by: str = "date", fmt: str = "parquet",
                      rebalance: bool = True) -> None:
    """Add rows, one folder per value of ``by``. A rerun adds them again."""
    partitioned(df, by, fmt, rebalance).mode("append").save(path)


def replace_partitions(df: DataFrame, path: str, by: str = "date", fmt: str = "parquet",
                       rebalance: bool = True) -> None:
    """Write rows and replace exactly the ``by`` folders they fall in. Safe to rerun."""
    (partitioned(df, by, fmt, rebalance).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").save(path))


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows without partitioning: logs, or new files in a folder being read."""
    df.write.format(fmt).mode("append").save(path)


def create_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table that must not exist yet."""
    df.write.format(fmt).mode("errorifexists").save(path)
