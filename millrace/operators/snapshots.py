"""Snapshot tables that are delivered again and again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, *delivery: Column) -> DataFrame:
    """One row per key: that of its latest delivery, copies of it counted once.

    ``delivery`` orders deliveries (say, modification time and path of the file). Two different rows of
    a key in its latest delivery raise an error when the query runs: neither is right. One aggregation, so
    copies of a key collapse in the map tasks.
    """
    columns = [F.col(name) for name in df.columns if name != key]
    row, digest = F.struct(*columns), F.xxhash64(*columns)
    # The largest digest and the largest complement, which is the smallest digest, of the latest delivery.
    found = df.groupBy(key).agg(
        F.max_by(row, F.struct(*delivery)).alias("row"),
        F.max(F.struct(*delivery, digest.alias("digest"))).alias("high"),
        F.max(F.struct(*delivery, F.bitwise_not(digest).alias("digest"))).alias("low"))
    message = F.concat(F.lit(f"different rows of one delivery for {key} "), F.col(key).cast("string"))
    one = F.when(F.col("high.digest") != F.bitwise_not(F.col("low.digest")),
                 F.raise_error(F.coalesce(message, F.lit(f"different rows without {key}")))).otherwise(F.col("row"))
    return found.select(key, one.alias("row")).select(
        *[F.col(name) if name == key else F.col(f"row.`{name}`").alias(name) for name in df.columns])


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row; a join on them would repeat the other side."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The table itself, after a look at its keys."""
    first = repeated_keys(df, key).first()
    if first is not None:
        raise ValueError(f"{first['n_rows']} rows with {key} {first[key]!r}")
    return df
