"""Adding refetched clicks to an incomplete table."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.incremental import within_dates
from millrace.operators.sets import rows_absent_from

# Columns of the repair log, in order, and the daily column each is taken from.
REPAIR_LOG_COLUMNS = (
    ("utc_date", "after.utc_date"),
    ("initial_number_of_hits", "before.num_of_hitid"),
    ("QA_number_of_hits", "after.num_of_hitid"),
    ("desired_number_of_hits", "after.hits_num"),
    ("initial_hit_completeness_rate", "before.hit_completeness"),
    ("QA_hit_completeness_rate", "after.hit_completeness"),
    ("initial_number_of_visitors", "before.num_of_visid"),
    ("QA_number_of_visitors", "after.num_of_visid"),
    ("desired_number_visitors", "after.visitors_num"),
    ("initial_visitors_completeness_rate", "before.visitors_completeness"),
    ("QA_visitors_completeness_rate", "after.visitors_completeness"),
    ("data_quality_reached_expectation", "after.reach_threshold"),
)


def gather_attempts(base: DataFrame, *attempts: DataFrame, start: date | None = None,
                    end: date | None = None) -> DataFrame:
    """All rows of the base and the refetches, columns by name, copies kept.

    Enough for distinct counts, which copies do not change, and it shuffles nothing. With
    ``start`` and ``end``, refetched rows outside the range are left out.
    """
    if start is not None and end is not None:
        attempts = tuple(within_dates(attempt, start, end) for attempt in attempts)
    return reduce(DataFrame.unionByName, attempts, base)


def merge_attempts(base: DataFrame, *attempts: DataFrame, start: date | None = None,
                   end: date | None = None) -> DataFrame:
    """Distinct rows of the base and the refetches."""
    return gather_attempts(base, *attempts, start=start, end=end).distinct()


def repair_delta(merged: DataFrame, base: DataFrame) -> DataFrame:
    """Distinct rows the base lacks.

    ``merged`` may be the refetched rows alone: rows of the base cancel out.
    """
    return rows_absent_from(merged, base)


def qa_repair_log(initial: DataFrame, final: DataFrame) -> DataFrame:
    """Per day: counts and rates before and after the repair, next to the expected ones."""
    columns = [F.col(source).alias(name) for name, source in REPAIR_LOG_COLUMNS]
    numbers = [name for name, _ in REPAIR_LOG_COLUMNS[1:-1]]
    same_day = F.col("after.utc_date") == F.col("before.utc_date")
    return (final.alias("after").join(initial.alias("before"), same_day)
            .select(*columns).fillna(0, numbers))
