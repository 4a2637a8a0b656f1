"""One key, day or group of copies with a third of all rows: right results, split work."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import bag, day, plan_of
from millrace.operators.completeness import daily_visitors_hits
from millrace.operators.gold import gold_transactions
from millrace.operators.incremental import late_rows
from millrace.operators.lookups import broadcast_if_small, measured_bytes
from millrace.operators.repair import merge_attempts, repair_delta
from millrace.operators.silver import silver_transactions
from millrace.operators.transaction_checks import duplicate_rows, transaction_checks

ROWS = 60_000


def hot(column, hot_value, cold):
    """``hot_value`` in every third row, ``cold`` in the others."""
    return F.when(F.col(column) % 3 == 0, hot_value).otherwise(cold)


def orders(spark, rows=ROWS):
    product = hot("id", F.lit("hot"), F.concat(F.lit("p"), (F.col("id") % 500).cast("string")))
    return spark.range(0, rows, 1, 8).select(
        hot("id", F.lit("big@x"), F.concat((F.col("id") % 900).cast("string"), F.lit("@x")))
        .alias("email"),
        F.array(product).alias("items"), F.col("id").cast("string").alias("order_id"),
        F.lit(1).alias("total_item_quantity"), F.lit(1).cast("decimal(18,2)").alias("total_purchase_usd"),
        F.lit(0).cast("bigint").alias("transaction_timestamp"),
        F.when(F.col("id") % 7 == 0, "return").otherwise("purchase").alias("transaction_type"),
        F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 20).cast("int")).alias("utc_date"))


def catalogue(spark):
    names = spark.range(500).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("product_id"))
    return names.union(spark.createDataFrame([("hot",)], "product_id string")).select(
        "product_id", F.col("product_id").alias("product_name"),
        F.lit(2).cast("decimal(18,2)").alias("price"))


@pytest.fixture
def no_broadcast(conf):
    """Products too large to broadcast, and partitions that count as skewed on test data."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")


def test_hot_product_is_split_when_products_are_too_large_to_broadcast(spark, no_broadcast):
    silver = silver_transactions(orders(spark), catalogue(spark)).drop("etl_loaded_at")
    got = Counter(row.product_id for row in silver.collect())
    assert got["hot"] == ROWS // 3 and sum(got.values()) == ROWS
    assert "skew=true" in plan_of(silver)


def test_hot_product_is_split_below_an_aggregation_too(spark, no_broadcast):
    gold = gold_transactions(silver_transactions(orders(spark), catalogue(spark)))
    total = sum(row.daily_signed_price for row in gold.collect())
    assert total == 2 * (ROWS - 2 * len(range(0, ROWS, 7)))
    assert "skew=true" in plan_of(gold)


def test_products_are_broadcast_by_measured_size(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    products = catalogue(spark)
    size = measured_bytes(products)
    assert 501 * 4 * 16 < size < 501 * 100
    small = silver_transactions(orders(spark, 100), broadcast_if_small(products))
    large = silver_transactions(orders(spark, 100), broadcast_if_small(products, size - 1))
    assert "BroadcastHashJoin" in plan_of(small) and "SortMergeJoin" in plan_of(large)
    assert small.count() == large.count() == 100
    assert measured_bytes(products.limit(0)) == 0
    assert measured_bytes(orders(spark, 1)) is None


def test_hot_customer_and_product_collapse_before_the_window(spark):
    silver = silver_transactions(orders(spark), catalogue(spark))
    gold = gold_transactions(silver)
    rows = gold.filter("email = 'big@x' and product_id = 'hot'").orderBy("date", "transaction_type")
    kept = rows.collect()
    assert len(kept) <= 20 * 2
    assert [row.previous_purchase_signed_price for row in kept[1:]] == [
        row.daily_signed_price for row in kept[:-1]]
    brute = {}
    for number in range(0, ROWS, 3):
        key = (number % 20, "return" if number % 7 == 0 else "purchase")
        brute[key] = brute.get(key, 0) + (-2 if number % 7 == 0 else 2)
    assert {((r.date - day("2024-01-01")).days, r.transaction_type): int(r.daily_signed_price)
            for r in kept} == brute
    assert plan_of(gold).count("partial_sum") == 1


def test_hot_day_is_counted_by_id_before_it_is_counted_by_day(spark):
    clicks = spark.range(0, ROWS, 1, 8).select(
        hot("id", F.lit(day("2024-01-01")),
            F.date_add(F.lit(day("2024-01-02")), (F.col("id") % 20).cast("int"))).alias("utc_date"),
        (F.col("id") % 1000).alias("visid_high"), F.lit(0).alias("visid_low"),
        F.col("id").alias("hitid_high"), F.lit(0).alias("hitid_low"))
    counts = daily_visitors_hits(clicks)
    first = {row.utc_date: (row.num_of_visid, row.num_of_hitid) for row in counts.collect()}
    assert first[day("2024-01-01")] == (1000, ROWS // 3)
    shuffles = [line for line in plan_of(counts).split("\n") if "hashpartitioning" in line]
    assert any("visid_high" in line and "hitid_high" in line for line in shuffles)


def test_copies_collapse_in_the_map_tasks(spark):
    base = spark.range(0, ROWS, 1, 8).select(
        hot("id", F.lit(-1), F.col("id")).alias("a"), F.lit("x").alias("b"))
    attempt = spark.range(0, ROWS, 1, 8).select(
        hot("id", F.lit(-2), F.col("id") + 30_000).alias("a"), F.lit("x").alias("b"))
    merged = merge_attempts(base, attempt)
    delta = repair_delta(merged, base)
    old = {-1} | {n for n in range(ROWS) if n % 3}
    new = {-2} | {n + 30_000 for n in range(ROWS) if n % 3}
    assert {row.a for row in delta.collect()} == new - old
    assert "Join" not in plan_of(delta)
    doubles = duplicate_rows(base)
    assert bag(doubles) == [(-1, "x", ROWS // 3)]
    assert "partial_count" in plan_of(doubles)


def test_hot_late_key(spark):
    source = spark.range(0, ROWS, 1, 8).select(
        hot("id", F.lit("late"), F.col("id").cast("string")).alias("order_id"),
        F.lit(day("2024-01-01")).alias("utc_date"))
    target = source.filter("order_id <> 'late'").withColumnRenamed("utc_date", "date")
    late = late_rows(source, target)
    assert bag(late) == [("late", day("2024-01-01"))]
    assert "Join" not in plan_of(late)


def test_checks_on_a_table_that_is_a_third_copies(spark):
    df = orders(spark)
    third = df.filter(F.col("email") == "big@x").withColumn("order_id", F.lit("same")) \
              .withColumn("utc_date", F.lit(day("2024-01-01"))).withColumn("transaction_type", F.lit("return"))
    dirty = df.unionByName(third)
    row = transaction_checks(dirty).first()
    assert (row.null_rows, row.duplicate_groups, row.surplus_rows) == (0, 1, ROWS // 3 - 1)
