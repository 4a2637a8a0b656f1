from datetime import date
from decimal import Decimal


def tuples(df):
    return [tuple(row) for row in df.collect()]


def bag(df):
    """Rows as a sorted list, NULLs and mixed types included."""
    return sorted(tuples(df), key=repr)


def day(text):
    return date.fromisoformat(text)


def money(text):
    return Decimal(text).quantize(Decimal("0.01"))


def plan_of(df):
    """Text of the physical plan, after execution the final one."""
    return df._jdf.queryExecution().executedPlan().toString()


SILVER = ("order_id string, email string, transaction_utc_timestamp string, "
          "transaction_type string, product_name string, product_id string, "
          "price decimal(18,2), date date")
GOLD = ("email string, product_id string, date date, year int, month int, "
        "transaction_type string, daily_signed_price decimal(18,2)")


def silver_rows(spark, rows):
    """``(email, product, day, type, price)`` rows as a silver table."""
    return spark.createDataFrame(
        [("o", e, "t", kind, "n", p, money(price), day(d)) for e, p, d, kind, price in rows],
        SILVER)
