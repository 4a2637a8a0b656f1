"""Joining a large table with a lookup table."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast table is built on the driver and held by every executor.
BROADCAST_BYTES = 128 * 1024 * 1024
FIELD_BYTES = 16


def field_bytes(field: T.StructField) -> Column:
    """Upper estimate of what one field takes in a row."""
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(field.name), F.lit(0)) + FIELD_BYTES
    return F.lit(FIELD_BYTES)


def measured_bytes(df: DataFrame) -> int | None:
    """Size of all rows, by one pass over them; None for nested types, which are not measured."""
    fields = df.schema.fields
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType,
                                   T.BinaryType)) for f in fields):
        return None
    row = reduce(add, [field_bytes(field) for field in fields], F.lit(FIELD_BYTES))
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("n")).first()["n"]


def broadcast_if_small(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The lookup with a broadcast hint if its rows, measured now, fit; otherwise as it is.

    The planner's own estimate of a derived table (say, a grouped one) is that of its input, so
    it would shuffle a large table to join a few rows. Without the hint the join is
    shuffled, and AQE splits the partition of a hot key.
    """
    size = measured_bytes(lookup)
    return F.broadcast(lookup) if size is not None and size <= max_bytes else lookup
