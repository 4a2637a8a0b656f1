"""Writers: each brings one table up to date and is safe to run again.

A load takes the days it is given (those the change log says are new or changed), else the days after the
watermark. Both are literals and prune folders of the source while planning. No ``count()`` guards a write:
an empty increment writes nothing.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.gold import (
    gold_after, gold_daily_signed, gold_transactions, last_entries, merged_entries,
)
from millrace.operators.incremental import after_watermark, high_watermark
from millrace.operators.lookups import broadcast_if_small
from millrace.operators.report import sales_report
from millrace.operators.silver import (
    silver_clickstream, silver_products, silver_transactions, silver_users,
)
from millrace.operators.snapshots import require_unique
from millrace.plans.state import GoldState, gold_state, record_gold, state_of
from millrace.sources.changes import on_days
from millrace.sources.layout import Layout
from millrace.sources.sinks import create_table, overwrite_table, replace_partitions
from millrace.sources.tables import scan_bronze, scan_if_present, scan_table


def watermark_of(spark: SparkSession, path: str, fmt: str = "parquet") -> date | None:
    """Latest date of a written table; None when it is missing or empty."""
    target = scan_if_present(spark, path, fmt)
    return None if target is None else high_watermark(target).first()["max_date"]


def load_users(spark: SparkSession, layout: Layout, loaded_at: datetime | None = None,
               fmt: str = "parquet") -> None:
    users = scan_table(spark, layout.table("bronze", "users"), fmt)
    overwrite_table(silver_users(users, loaded_at), layout.table("silver", "users"), fmt)


def load_products(spark: SparkSession, layout: Layout, loaded_at: datetime | None = None,
                  fmt: str = "parquet") -> None:
    products = scan_table(spark, layout.table("bronze", "products"), fmt)
    overwrite_table(silver_products(products, loaded_at), layout.table("silver", "products"), fmt)


def mark_of(spark: SparkSession, layout: Layout, name: str, fmt: str = "parquet") -> date | None:
    """Up to which day a fact table is loaded, as finished runs recorded it. Only where none did, the
    silver table itself is asked, whose footers are all read for that."""
    recorded = state_of(spark, layout, name).loaded_to
    return recorded or watermark_of(spark, layout.table("silver", name), fmt)


def load_transactions(spark: SparkSession, layout: Layout, loaded_at: datetime | None = None,
                      after: date | None = None, fmt: str = "parquet",
                      days: Collection[date | None] | None = None) -> None:
    """Load the given ``days`` of bronze, else those after ``after``, else those after the watermark.

    Products must be unique by id, as every sale would be repeated otherwise.
    """
    path = layout.table("silver", "transactions")
    source = new_days(spark, layout, "transactions", path, after, days, fmt)
    products = require_unique(scan_table(spark, layout.table("bronze", "products"), fmt), "product_id")
    replace_partitions(silver_transactions(source, broadcast_if_small(products), loaded_at), path, fmt=fmt)


def load_clickstream(spark: SparkSession, layout: Layout, loaded_at: datetime | None = None,
                     after: date | None = None, fmt: str = "parquet", rebalance: bool = True,
                     days: Collection[date | None] | None = None) -> None:
    """As ``load_transactions``, for clicks.

    Nothing in it shuffles, so with bronze in large files of one day each ``rebalance=False``
    makes the load a pure scan and write.
    """
    path = layout.table("silver", "clickstream")
    source = new_days(spark, layout, "clickstream", path, after, days, fmt)
    replace_partitions(silver_clickstream(source, loaded_at), path, fmt=fmt,
                       rebalance=rebalance)


def new_days(spark: SparkSession, layout: Layout, name: str, target: str, after: date | None,
             days: Collection[date | None] | None, fmt: str) -> DataFrame:
    bronze = scan_bronze(spark, layout, name)
    if days is not None:
        return on_days(bronze, days)
    return after_watermark(bronze, after or watermark_of(spark, target, fmt))


def refresh_gold(spark: SparkSession, layout: Layout, after: date | None = None,
                 fmt: str = "parquet") -> None:
    """Bring gold up to date with the silver days it lacks, and with those after ``after``.

    Days before the refreshed ones are not written, so a run that failed half-way is repeated with the
    same ``after``. An increment continues from the table of last entries, one row per customer and product,
    and reads no gold day. A late day changes the previous entry of later rows: every day from there
    on is rewritten, and the entries before it are gathered from gold once more.
    """
    silver = scan_table(spark, layout.table("silver", "transactions"), fmt)
    path = layout.table("gold", "transactions")
    state = gold_state(spark, layout)
    mark = state.loaded_to if state else watermark_of(spark, path, fmt)
    if mark is None:
        overwrite_table(gold_transactions(silver), path, fmt, by="date")
        keep_entries(spark, layout, last_entries(scan_table(spark, path, fmt)), state)
        return
    known_to = mark if after is None else min(after, mark)
    new_silver = silver.filter(F.col("date") > F.lit(known_to))
    if new_silver.isEmpty():
        return
    last = entries_through(spark, layout, known_to, state, fmt)
    replace_partitions(gold_after(gold_daily_signed(new_silver), last), path, fmt=fmt)
    written = scan_table(spark, path, fmt).filter(F.col("date") > F.lit(known_to))
    keep_entries(spark, layout, merged_entries(last, written), state)


def entries_through(spark: SparkSession, layout: Layout, day: date, state: GoldState | None,
                    fmt: str = "parquet") -> DataFrame:
    """Last entry of every customer and product as of a day: the stored table if it is of that day."""
    if state is not None and state.loaded_to == day:
        return scan_table(spark, layout.entries(state.slot))
    gold = scan_table(spark, layout.table("gold", "transactions"), fmt)
    return last_entries(gold.filter(F.col("date") <= F.lit(day)))


def keep_entries(spark: SparkSession, layout: Layout, entries: DataFrame, before: GoldState | None) -> None:
    """Write the entries to the slot not in use, then record it: a run that dies leaves the old ones."""
    slot = 0 if before is None else 1 - before.slot
    overwrite_table(entries, layout.entries(slot))
    latest = scan_table(spark, layout.entries(slot)).agg(F.max("date")).first()[0]
    if latest is not None:
        record_gold(spark, layout, GoldState(latest, slot))


def report_of(spark: SparkSession, layout: Layout, product_id: str | None = None,
              as_of: date | None = None, fmt: str = "parquet") -> DataFrame:
    gold = scan_table(spark, layout.table("gold", "transactions"), fmt)
    products = scan_table(spark, layout.table("silver", "products"), fmt)
    return sales_report(gold, products, product_id, as_of)


def write_report(spark: SparkSession, layout: Layout, name: str, product_id: str | None = None,
                 as_of: date | None = None, fmt: str = "parquet") -> None:
    """Save the report under a new name; an existing report is never replaced."""
    create_table(report_of(spark, layout, product_id, as_of, fmt), layout.report(name), fmt)


def finish_report(spark: SparkSession, layout: Layout, name: str, product_id: str | None = None,
                  as_of: date | None = None, fmt: str = "parquet") -> None:
    """As ``write_report``, for a run that may have died while it saved this very report."""
    overwrite_table(report_of(spark, layout, product_id, as_of, fmt), layout.report(name), fmt)


def next_fetch(spark: SparkSession, layout: Layout, name: str, as_of: date,
               first_day: date, fmt: str = "parquet") -> tuple[date, date]:
    """Days to fetch next: from the day after the last loaded one up to yesterday."""
    mark = mark_of(spark, layout, name, fmt)
    start = first_day if mark is None else mark + timedelta(days=1)
    return start, as_of - timedelta(days=1)
