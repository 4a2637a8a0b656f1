"""Expected daily totals supplied by the caller."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.schemas import CONTROL_TOTALS_SCHEMA


def control_totals(spark: SparkSession, rows: Iterable[tuple[date, int | None, int | None]]) -> DataFrame:
    """``(day, hits, visitors)`` rows as a table: one per day, so a few thousand at most.

    Totals that already are a table need no such copy; every operator takes any DataFrame.
    """
    return spark.createDataFrame(list(rows), schema=CONTROL_TOTALS_SCHEMA)
