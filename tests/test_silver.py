from datetime import datetime

from helpers import day, money, tuples
from millrace.operators.silver import (
    SILVER_CLICKSTREAM_COLUMNS, explode_items, silver_clickstream, silver_products,
    silver_transactions, silver_users,
)
from millrace.sources.schemas import BRONZE_SCHEMAS

AT = datetime(2024, 1, 2, 3, 4, 5)


def transactions(spark, items_by_order):
    rows = [("a@x", items, order, 1, money("1"), 86400, "purchase", day("1970-01-02"))
            for order, items in items_by_order]
    return spark.createDataFrame(rows, BRONZE_SCHEMAS["transactions"])


def test_explode_drops_empty_and_null_arrays(spark):
    df = transactions(spark, [("1", ["a", "b"]), ("2", []), ("3", None)])
    out = explode_items(df)
    assert out.columns == df.columns + ["product_id"]
    assert tuples(out.select("order_id", "product_id")) == [("1", "a"), ("1", "b")]


def test_transactions_join_products_and_drop_unknown(spark):
    df = transactions(spark, [("1", ["a", "a", "x"])])
    products = spark.createDataFrame([("a", "Ann", money("2.50"))], BRONZE_SCHEMAS["products"])
    out = silver_transactions(df, products, AT)
    assert out.columns == ["order_id", "email", "transaction_utc_timestamp", "transaction_type",
                           "product_name", "product_id", "price", "etl_loaded_at", "date"]
    row = ("1", "a@x", "1970-01-02 00:00:00", "purchase", "Ann", "a", money("2.50"), AT,
           day("1970-01-02"))
    assert tuples(out) == [row, row]


def test_users_and_products(spark):
    users = spark.createDataFrame([("7", "u@x", 60)], BRONZE_SCHEMAS["users"])
    assert tuples(silver_users(users, AT)) == [("7", "u@x", "1970-01-01 00:01:00", AT)]
    products = spark.createDataFrame([("a", "Ann", money("1"))], BRONZE_SCHEMAS["products"])
    assert tuples(silver_products(products, AT)) == [("a", "Ann", money("1"), AT)]


def test_clickstream_columns_and_times(spark):
    values = {"cust_hit_time_gmt": 1, "first_hit_time_gmt": 2, "hit_time_gmt": 3,
              "visit_start_time_gmt": 4, "utc_date": day("2024-01-01"), "os": "linux"}
    names = [column.split()[0] for column in BRONZE_SCHEMAS["clickstream"].split(", ")]
    clicks = spark.createDataFrame([tuple(values.get(n) for n in names)],
                                   BRONZE_SCHEMAS["clickstream"])
    out = silver_clickstream(clicks, AT)
    assert tuple(out.columns) == SILVER_CLICKSTREAM_COLUMNS and len(out.columns) == 24
    row = out.first()
    assert [row[f"{n}_gmt_timestamp"][-2:] for n in ("cust_hit", "first_hit", "hit", "visit_start")] \
        == ["01", "02", "03", "04"]
    assert (row["os"], row["date"], row["etl_loaded_at"]) == ("linux", day("2024-01-01"), AT)


def test_load_time_defaults_to_now(spark):
    users = spark.createDataFrame([("7", "u@x", 60)], BRONZE_SCHEMAS["users"])
    assert abs((silver_users(users).first()["etl_loaded_at"] - datetime.now()).total_seconds()) < 90000
