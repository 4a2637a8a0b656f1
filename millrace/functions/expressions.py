"""Column expressions. All are built-ins, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(22,4)"
# Ratios pass through this type before rounding: rounding a double directly depends on the
# engine's half-way handling of binary fractions.
RATIO = "decimal(28,10)"

# Month labels of the report, January first.
MONTH_LABELS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun",
                "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Fixed value: the transaction type that counts negative.
RETURN = "return"


def utc_string(epoch_seconds: str) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session time zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (epoch + F.make_dt_interval(secs=F.col(epoch_seconds))).cast("string")


def signed_price() -> Column:
    """The price, negative for a return."""
    return (F.when(F.col("transaction_type") == RETURN, -F.col("price"))
             .otherwise(F.col("price")))


def adjusted_signed_price() -> Column:
    """Daily signed price plus the previous entry; a return without one stands alone."""
    lone_return = ((F.col("transaction_type") == RETURN)
                   & F.col("previous_purchase_signed_price").isNull())
    own = F.col("daily_signed_price")
    return (F.when(lone_return, own)
             .otherwise(own + F.col("previous_purchase_signed_price"))
             .cast(MONEY))


def rounded_ratio(part: Column, whole: Column, scale: int, factor: int = 1) -> Column:
    """``part / whole * factor`` rounded half-up; NULL where ``whole`` is 0 or NULL."""
    ratio = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * F.lit(factor)
    return F.round(ratio.cast(RATIO), scale)


def month_label(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(label) for label in MONTH_LABELS]), month)


def month_end_cutoff(latest: Column) -> Column:
    """Last day of the last month that is complete when data reaches up to ``latest``."""
    return (F.when(F.last_day(latest) == latest, latest)
             .otherwise(F.last_day(F.add_months(latest, -1))))


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, [F.col(name).isNull() for name in columns])


def rate_literal(threshold: float) -> Column:
    return F.lit(Decimal(str(threshold))).cast(RATE)
