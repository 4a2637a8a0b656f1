"""Set difference of whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_absent_from(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; NULL equals NULL.

    One aggregation keyed by every column: copies of a row collapse inside the map tasks, so a
    group of copies, however large, reaches its reducer as one row per map task.
    ``DataFrame.subtract`` gives the same rows but joins before it deduplicates, with more
    shuffles and all copies of a row in one task.
    """
    columns = left.columns
    held = "_held"
    while held in columns:
        held += "_"
    tagged = (left.withColumn(held, F.lit(False))
              .unionByName(right.select(*columns).withColumn(held, F.lit(True))))
    return (tagged.groupBy(*columns).agg(F.bool_or(held).alias(held))
            .filter(~F.col(held)).select(*columns))
