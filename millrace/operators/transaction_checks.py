"""Null, duplicate and column checks of the transactions table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import any_null
from millrace.sources.schemas import TRANSACTION_COLUMNS, TRANSACTION_NOT_NULL


def null_rows(df: DataFrame, columns: Iterable[str] = TRANSACTION_NOT_NULL) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    return df.filter(any_null(columns))


def row_groups(df: DataFrame) -> DataFrame:
    """Every distinct row with the number of its copies, ``n_dup``.

    Copies are counted in the map tasks before the shuffle.
    """
    return df.groupBy(*df.columns).agg(F.count("*").alias("n_dup"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, one row per group of copies."""
    return row_groups(df).filter(F.col("n_dup") > 1)


def column_conformance(df: DataFrame,
                       required: Iterable[str] = TRANSACTION_COLUMNS) -> dict[str, list[str]]:
    """Columns the table lacks and columns it should not have."""
    have, need = set(df.columns), set(required)
    return {"missing": sorted(need - have), "extra": sorted(have - need)}


def column_check(files: DataFrame, required: Iterable[str] = TRANSACTION_COLUMNS) -> DataFrame:
    """Per delivered file (``file, rows, columns``) what it lacks and adds, and pass or fail."""
    need = F.array(*[F.lit(name) for name in required])
    conforming = (F.size("missing") == 0) & (F.size("extra") == 0)
    return (files.select("file", "rows", F.array_sort(F.array_except(need, F.col("columns"))).alias("missing"),
                         F.array_sort(F.array_except(F.col("columns"), need)).alias("extra"))
            .withColumn("all_cols_check", F.when(conforming, F.lit("pass")).otherwise(F.lit("fail"))))


def day_checks(df: DataFrame, not_null: Iterable[str] = TRANSACTION_NOT_NULL) -> DataFrame:
    """Per day the counts behind the checks. Copies share all columns, the day too, so days add up."""
    copies = F.col("n_dup")
    return row_groups(df).groupBy("utc_date").agg(
        F.sum(copies).alias("rows"),
        F.coalesce(F.sum(F.when(any_null(not_null), copies)), F.lit(0)).cast("bigint").alias("null_rows"),
        F.count_if(copies > 1).alias("duplicate_groups"),
        F.sum(copies - 1).alias("surplus_rows"))


def merged_checks(days: DataFrame, conforming: Column | None = None) -> DataFrame:
    """The row of ``transaction_checks`` from day counts; ``conforming`` is the verdict on the columns."""
    counts = days.agg(*[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name)
                        for name in ("null_rows", "duplicate_groups", "surplus_rows")])

    def verdict(passed: Column) -> Column:
        return F.when(passed, F.lit("pass")).otherwise(F.lit("fail"))

    return counts.select(verdict(F.col("null_rows") == 0).alias("null_check"),
                         verdict(F.col("duplicate_groups") == 0).alias("duplicates_check"),
                         verdict(F.lit(True) if conforming is None else conforming).alias("all_cols_check"),
                         *counts.columns)


def transaction_checks(df: DataFrame, not_null: Iterable[str] = TRANSACTION_NOT_NULL,
                       required: Iterable[str] = TRANSACTION_COLUMNS) -> DataFrame:
    """One row: pass or fail per check, and the counts behind it, from one pass over the table.

    A missing column fails the column check; the null check covers those that are present.
    """
    conformance = column_conformance(df, required)
    present = [name for name in not_null if name in df.columns]
    has_null = any_null(present) if present else F.lit(False)
    copies = F.col("n_dup")

    def verdict(failed: Column) -> Column:
        return F.when(failed, F.lit("fail")).otherwise(F.lit("pass"))

    def total(amount: Column) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0)).cast("bigint")

    counts = row_groups(df).agg(
        total(F.when(has_null, copies)).alias("null_rows"),
        F.count_if(copies > 1).alias("duplicate_groups"),
        total(copies - 1).alias("surplus_rows"),
    )
    return counts.select(
        verdict(F.col("null_rows") > 0).alias("null_check"),
        verdict(F.col("duplicate_groups") > 0).alias("duplicates_check"),
        verdict(F.lit(bool(conformance["missing"] or conformance["extra"]))).alias("all_cols_check"),
        "null_rows", "duplicate_groups", "surplus_rows",
    )
