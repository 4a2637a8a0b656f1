from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import day, tuples
from millrace.functions.expressions import (
    month_end_cutoff, month_label, rounded_ratio, signed_price, utc_string,
)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_string_does_not_depend_on_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([(1600000000,), (0,), (-1,), (1710054000,), (None,)], "s bigint")
    assert tuples(df.select(utc_string("s"))) == [
        ("2020-09-13 12:26:40",), ("1970-01-01 00:00:00",), ("1969-12-31 23:59:59",),
        ("2024-03-10 07:00:00",), (None,)]


def test_utc_string_equals_from_unixtime_in_utc(spark):
    df = spark.range(0, 2_000_000_000, 7_654_321).withColumnRenamed("id", "s")
    assert df.filter(utc_string("s") != F.from_unixtime("s")).count() == 0


def test_signed_price(spark):
    df = spark.createDataFrame([("return", 5), ("purchase", 5), (None, 5), ("return", None)],
                               "transaction_type string, price int")
    assert tuples(df.select(signed_price())) == [(-5,), (5,), (5,), (None,)]


def test_rounded_ratio_is_half_up_and_null_safe(spark):
    df = spark.createDataFrame([(1, 8), (1, 0), (None, 3), (3, None), (-1, 8)], "a int, b int")
    got = [row[0] for row in df.select(rounded_ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [Decimal("0.13"), None, None, None, Decimal("-0.13")]


def test_month_labels(spark):
    df = spark.range(1, 13).select(month_label(F.col("id").cast("int")))
    assert "".join(row[0] for row in df.collect()) == "JanFebMarAprMayJunJulAugSepOctNovDec"


@pytest.mark.parametrize("latest, cutoff", [
    ("2001-08-01", "2001-07-31"), ("2001-07-31", "2001-07-31"), ("2001-07-30", "2001-06-30"),
    ("2001-01-15", "2000-12-31"), ("2024-02-29", "2024-02-29"), ("2024-02-28", "2024-01-31"),
    ("2023-03-30", "2023-02-28"),
])
def test_month_end_cutoff(spark, latest, cutoff):
    df = spark.range(1).select(month_end_cutoff(F.lit(day(latest))))
    assert df.first()[0] == day(cutoff)
