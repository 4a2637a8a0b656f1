import pytest

from helpers import day, money, tuples
from millrace.operators.transaction_checks import (
    column_conformance, duplicate_rows, null_rows, transaction_checks,
)
from millrace.sources.schemas import BRONZE_SCHEMAS, TRANSACTION_COLUMNS, TRANSACTION_NOT_NULL

GOOD = {"email": "a@x", "items": ["i"], "order_id": "1", "total_item_quantity": 1,
        "total_purchase_usd": money("1"), "transaction_timestamp": 1,
        "transaction_type": "purchase", "utc_date": day("2024-01-01")}


def table(spark, *changes):
    rows = [tuple({**GOOD, **change}[name] for name in TRANSACTION_COLUMNS) for change in changes]
    return spark.createDataFrame(rows, BRONZE_SCHEMAS["transactions"])


def test_clean_table_passes(spark):
    df = table(spark, {}, {"order_id": "2"})
    assert tuples(transaction_checks(df)) == [("pass", "pass", "pass", 0, 0, 0)]


def test_empty_table_passes(spark):
    assert tuples(transaction_checks(table(spark))) == [("pass", "pass", "pass", 0, 0, 0)]


@pytest.mark.parametrize("name", TRANSACTION_COLUMNS)
def test_null_check_covers_six_columns(spark, name):
    df = table(spark, {name: None}, {"order_id": "2"})
    found = int(name in TRANSACTION_NOT_NULL)
    assert null_rows(df).count() == found
    assert transaction_checks(df).first()["null_rows"] == found


def test_groups_and_surplus_rows_are_both_reported(spark):
    df = table(spark, {}, {}, {}, {"order_id": "2", "email": None}, {"order_id": "2", "email": None},
               {"order_id": "3"})
    assert tuples(transaction_checks(df)) == [("fail", "fail", "pass", 2, 2, 3)]
    got = {row.order_id: row.n_dup for row in duplicate_rows(df).collect()}
    assert got == {"1": 3, "2": 2}


def test_arrays_are_compared_by_content(spark):
    df = table(spark, {"items": ["a", "b"]}, {"items": ["b", "a"]}, {"items": None})
    assert duplicate_rows(df).count() == 0


def test_a_column_named_count_does_not_disturb(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5)], "a int, count int")
    assert tuples(duplicate_rows(df)) == [(1, 5, 2)]


def test_columns(spark):
    df = table(spark, {})
    assert column_conformance(df) == {"missing": [], "extra": []}
    wrong = df.drop("email").withColumnRenamed("items", "goods")
    assert column_conformance(wrong) == {"missing": ["email", "items"], "extra": ["goods"]}
    assert transaction_checks(wrong).first()["all_cols_check"] == "fail"
