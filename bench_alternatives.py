"""Operators against a plain formulation of the same result, on written tables.

``BENCH_SF_DIR``, ``BENCH_CPUS``, ``BENCH_RUNS`` as for ``bench.py``; ``BENCH_COPIES`` enlarges the
inputs by copies with ids of their own. Inputs are written once to
the folder for intermediate tables, so only the operators are timed. Prints one line per pair:
seconds of ours, seconds of the plain form, and whether the rows agree.
"""

from __future__ import annotations

import os
import statistics
import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import completeness, gold, lookups, repair, report, silver
from millrace.operators import transaction_checks as checks
from millrace.session import build_session, shared_folder
from verification import scenarios as sc


# Columns that make a copy's rows differ from the others'.
COPY_KEYS = {"transactions": ("email", "order_id"), "tx_dirty": ("email", "order_id"),
             "products": (), "clickstream": ("hitid_high", "visid_high"),
             "clicks_base": ("hitid_high", "visid_high"),
             "clicks_attempt": ("hitid_high", "visid_high")}


def enlarged(df: DataFrame, keys: tuple[str, ...], copies: int) -> DataFrame:
    if copies == 1 or not keys:
        return df
    copy = F.col("_copy")
    kinds = dict(df.dtypes)
    changed = {key: F.concat(key, F.lit("~"), copy.cast("string")) if kinds[key] == "string"
               else F.col(key) + copy * 10_000_000 for key in keys}
    return (df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
            .withColumns(changed).drop("_copy"))


def inputs(spark: SparkSession, sf_dir: str, copies: int) -> dict[str, DataFrame]:
    base = f"{shared_folder(spark)}/millrace/bench-{uuid4().hex}"
    made = {name: enlarged(getattr(sc, name)(spark, sf_dir), keys, copies)
            for name, keys in COPY_KEYS.items()}
    tables = {}
    for name, rows in made.items():
        rows.repartition(8).write.parquet(f"{base}/{name}")
        tables[name] = spark.read.parquet(f"{base}/{name}")
    sold = silver.silver_transactions(tables["transactions"], tables["products"])
    sold.write.parquet(f"{base}/silver")
    tables["silver"] = spark.read.parquet(f"{base}/silver")
    gold.gold_transactions(tables["silver"]).write.parquet(f"{base}/gold")
    tables["gold"] = spark.read.parquet(f"{base}/gold")
    return tables


def two_counts_joined(clicks: DataFrame) -> DataFrame:
    """Visitors and hits counted apart and joined."""
    def count(high, low, name):
        both = F.concat_ws("-", high, low)
        return clicks.groupBy("utc_date").agg(F.countDistinct(both).alias(name))
    return count("visid_high", "visid_low", "num_of_visid").join(
        count("hitid_high", "hitid_low", "num_of_hitid"), "utc_date")


def three_checks(df: DataFrame) -> DataFrame:
    """Nulls and duplicates counted by a job each."""
    nulls = checks.null_rows(df).count()
    groups = checks.duplicate_rows(df).count()
    return df.sparkSession.range(1).select(F.lit(nulls).cast("bigint").alias("null_rows"),
                                           F.lit(groups).cast("bigint").alias("duplicate_groups"))


def six_key_gold(sold: DataFrame) -> DataFrame:
    """Date parts as grouping keys."""
    keys = ("email", "product_id", "date", "year", "month", "transaction_type")
    daily = (gold.with_signed_price(sold)
             .withColumns({"year": F.year("date"), "month": F.month("date")})
             .groupBy(*keys).agg(F.sum("signed_price").cast("decimal(18,2)")
                                 .alias("daily_signed_price")))
    return gold.with_previous(daily)


def sorted_first(monthly: DataFrame) -> DataFrame:
    """Monthly growth with a global sort before the window."""
    return report.mom_growth(monthly.orderBy("year", "month"))


def pairs(t: dict[str, DataFrame]):
    ids = [t[name].select(*sc.CLICK_IDS) for name in ("clicks_base", "clicks_attempt")]
    merged = repair.merge_attempts(*ids)
    monthly = report.monthly_sales(t["gold"])
    cheap = ("null_rows", "duplicate_groups")
    yield ("distinct hits and visitors", lambda: completeness.daily_visitors_hits(t["clickstream"]),
           lambda: two_counts_joined(t["clickstream"]))
    yield ("rows to repair, wide", lambda: repair.repair_delta(t["clicks_attempt"], t["clicks_base"]),
           lambda: t["clicks_attempt"].union(t["clicks_base"]).distinct().subtract(t["clicks_base"]))
    yield ("rows to repair, ids", lambda: repair.repair_delta(ids[1], ids[0]),
           lambda: merged.subtract(ids[0]))
    yield ("transaction checks", lambda: checks.transaction_checks(t["tx_dirty"]).select(*cheap),
           lambda: three_checks(t["tx_dirty"]))
    yield ("gold", lambda: gold.gold_transactions(t["silver"]), lambda: six_key_gold(t["silver"]))
    yield ("growth", lambda: report.mom_growth(monthly), lambda: sorted_first(monthly))
    yield ("silver transactions",
           lambda: silver.silver_transactions(t["transactions"], lookups.broadcast_if_small(t["products"]))
           .drop("etl_loaded_at"),
           lambda: silver.silver_transactions(t["transactions"], t["products"].hint("merge"))
           .drop("etl_loaded_at"))


def seconds(queries, runs: int) -> list[float]:
    """Median time of each query, run in turn so that warm-up and memory affect all alike."""
    times = [[] for _ in queries]
    for _ in range(runs + 1):
        for query, taken in zip(queries, times):
            began = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
    return [statistics.median(taken[1:]) for taken in times]


def same(one: DataFrame, two: DataFrame) -> bool:
    columns = sorted(one.columns)
    def digest(df):
        row = F.xxhash64(*columns).cast("decimal(38,0)")
        return tuple(df.select(*columns).agg(F.count("*"), F.sum(row)).first())
    return digest(one) == digest(two)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("alternatives", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    tables = inputs(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"),
                    int(os.environ.get("BENCH_COPIES", "1")))
    for name, ours, plain in pairs(tables):
        mine, theirs = seconds((ours, plain), runs)
        print(f"{name:28} {mine:7.3f} {theirs:7.3f} "
              f"{'same' if same(ours(), plain()) else 'DIFFERENT'}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
