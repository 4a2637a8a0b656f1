"""Quality runs: check, repair and log.

Counts per day are kept (``counts_of_days``, ``summarise_days``): a run counts the days the change log names and
adds up or compares the stored counts of all others.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.completeness import (
    MAX_FAILING_DAYS, THRESHOLD, completeness_daily, completeness_of_counts, completeness_verdict,
    daily_visitors_hits,
)
from millrace.operators.incremental import date_bounds, within_dates
from millrace.operators.repair import gather_attempts, qa_repair_log, repair_delta
from millrace.operators.transaction_checks import column_check, day_checks, merged_checks
from millrace.plans.state import latest_days, write_days
from millrace.sources.changes import (
    REPAIRED, adopt_bronze, changes, days_of, on_days, parts_of, pending, record_changes, take, without_file,
)
from millrace.sources.footers import delivered_files, file_columns
from millrace.sources.layout import Layout, run_stamp
from millrace.sources.schemas import BRONZE_SCHEMAS
from millrace.sources.sinks import overwrite_table
from millrace.sources.tables import scan_bronze, scan_if_present, scan_refetch, scan_table

COUNTS, CHECKS = "counts", "checks"  # consumers of the change log
DAY_COUNTS = "utc_date date, num_of_visid bigint, num_of_hitid bigint"


def log_daily(spark: SparkSession, daily: DataFrame, path: str, fmt: str) -> DataFrame:
    """Write the per-day counts (one row per day) and continue from the written table."""
    overwrite_table(daily, path, fmt)
    return scan_table(spark, path, fmt)


def is_complete(daily: DataFrame, max_failing_days: int) -> bool:
    return completeness_verdict(daily, max_failing_days).first()["complete"]


def bronze_clicks(spark: SparkSession, layout: Layout, without_run: str | None = None) -> DataFrame:
    try:
        return scan_bronze(spark, layout, "clickstream", without_run=without_run)
    except FileNotFoundError:
        return spark.createDataFrame([], BRONZE_SCHEMAS["clickstream"])


def counts_of_days(spark: SparkSession, layout: Layout, at: datetime,
                   without_run: str | None = None) -> DataFrame:
    """Distinct visitors and hits of every day of bronze: stored ones, and those of changed days anew.

    ``without_run`` names a repair run whose rows don't count: its days are counted again without them.
    """
    adopt_bronze(spark, layout, "clickstream")
    log = pending(spark, layout, "clickstream", COUNTS)
    days, parts = set(days_of(log)), parts_of(log)
    every = changes(spark, layout, "clickstream")
    if without_run is not None and every is not None:
        days |= set(days_of(every.filter((F.col("feed") == REPAIRED) & (F.col("part") == without_run))))
    path = layout.qa("clickstream", "days")
    if days:
        clicks = on_days(bronze_clicks(spark, layout, without_run), days)
        # A day without rows left is a day with no hits, not one with the old counts.
        listed = spark.createDataFrame([(day,) for day in days], "utc_date date")
        counted = listed.join(daily_visitors_hits(clicks), "utc_date", "left").fillna(0)
        write_days(counted.filter("utc_date IS NOT NULL"), path, f"{run_stamp(at)}-before")
        take(spark, layout, "clickstream", COUNTS, parts)
    stored = latest_days(spark, path)
    return spark.createDataFrame([], DAY_COUNTS) if stored is None else stored


def repair_clickstream(spark: SparkSession, layout: Layout, control: DataFrame, start: date,
                       end: date, at: datetime, attempts: Sequence[str] = (),
                       threshold: float = THRESHOLD, max_failing_days: int = MAX_FAILING_DAYS,
                       fmt: str = "parquet") -> bool:
    """Check bronze clicks of ``[start, end]``; while incomplete, take in the next refetch.

    ``attempts`` are folders of refetched files, used in order and only as far as needed; all of
    them may be needed, and an empty or absent one adds nothing.
    Rows they add go to bronze once, under a folder of this run (a rerun replaces it), and the
    log compares the days before and after. Returns whether the range is complete.

    Only days that changed since they were counted last are counted for the first check, and only days a
    refetch has rows of after it. Counts are distinct counts, so the checks run over base and refetches
    side by side; whole rows are shuffled only once, those of refetched days, for the rows to add.
    """
    folder, run_id = layout.qa_log("clickstream", at), f"r{run_stamp(at)}"
    counts = counts_of_days(spark, layout, at, without_run=run_id)
    initial = log_daily(spark, completeness_of_counts(counts, control, start, end, threshold),
                        f"{folder}/initial", fmt)
    base = within_dates(bronze_clicks(spark, layout, run_id), start, end)
    complete, final = is_complete(initial, max_failing_days), initial
    used: list[DataFrame] = []
    days: set[date | None] = set()
    recounted = f"{folder}/recounted"
    for attempt in attempts:
        if complete:
            break
        used.append(within_dates(scan_refetch(spark, attempt, BRONZE_SCHEMAS["clickstream"]),
                                 start, end))
        days |= set(days_of(used[-1]))
        gathered = gather_attempts(on_days(base, days), *used)
        overwrite_table(daily_visitors_hits(gathered), recounted)
        now = scan_table(spark, recounted).unionByName(counts.filter(~known(days)))
        final = log_daily(spark, completeness_of_counts(now, control, start, end, threshold),
                          f"{folder}/after{len(used)}", fmt)
        complete = is_complete(final, max_failing_days)
    if used:
        path = f"{layout.repaired('clickstream')}/run_id={run_id}"
        delta = repair_delta(gather_attempts(*used), on_days(base, days))
        overwrite_table(delta, path, by="utc_date")
        added = scan_if_present(spark, path)
        if added is None:  # nothing to add, no file to read a schema from
            added = spark.createDataFrame([], BRONZE_SCHEMAS["clickstream"])
        record_changes(without_file(added), layout, "clickstream", REPAIRED, run_id)
        write_days(scan_table(spark, recounted), layout.qa("clickstream", "days"), f"{run_stamp(at)}-repaired")
        own = changes(spark, layout, "clickstream").filter((F.col("feed") == REPAIRED) & (F.col("part") == run_id))
        take(spark, layout, "clickstream", COUNTS, parts_of(own))
        overwrite_table(qa_repair_log(initial, final), f"{folder}/repair", fmt)
    return complete


def known(days: Collection[date | None]) -> "F.Column":
    return F.col("utc_date").isin([day for day in days if day is not None])


def check_history(spark: SparkSession, layout: Layout, control: DataFrame, threshold: float = THRESHOLD,
                  fmt: str = "parquet") -> DataFrame | None:
    """Completeness of every day between the first and the last with clicks, from the stored counts.

    Without stored counts bronze is counted; without clicks there is nothing to check.
    """
    counts = latest_days(spark, layout.qa("clickstream", "days"))
    if counts is None:
        counts = daily_visitors_hits(bronze_clicks(spark, layout))
    bounds = date_bounds(counts.filter("num_of_hitid > 0")).first()
    if bounds["min_date"] is None:
        return None
    return completeness_of_counts(counts, control, bounds["min_date"], bounds["max_date"], threshold)


def log_history(spark: SparkSession, layout: Layout, control: DataFrame, threshold: float = THRESHOLD,
                fmt: str = "parquet") -> None:
    """Keep the completeness of all days as a table."""
    history = check_history(spark, layout, control, threshold, fmt)
    if history is not None:
        overwrite_table(history, layout.qa("clickstream", "history"), fmt)


def first_failing_day(spark: SparkSession, layout: Layout, control: DataFrame, end: date,
                      threshold: float = THRESHOLD) -> date | None:
    """The earliest day with expected totals that the stored counts don't reach."""
    counts = latest_days(spark, layout.qa("clickstream", "days"))
    start = date_bounds(control).first()["min_date"]
    if counts is None or start is None or start > end:
        return None
    daily = completeness_of_counts(counts, control, start, end, threshold)
    return date_bounds(daily.filter(~F.col("reach_threshold") & (F.col("hits_num") > 0))).first()["min_date"]


def check_delivered_columns(spark: SparkSession, layout: Layout, name: str, at: datetime) -> None:
    """Compare the columns of files not loaded yet with the declared ones; one row per file is kept."""
    files = delivered_files(spark, layout.landing(name))
    log = changes(spark, layout, name)
    if log is not None:
        files = files.join(log.select("file").distinct(), "file", "left_anti")
    required = [column.split()[0] for column in BRONZE_SCHEMAS[name].split(", ")]
    overwrite_table(column_check(file_columns(files), required), columns_path(layout, name, at))


def columns_path(layout: Layout, name: str, at: datetime) -> str:
    return f"{layout.qa(name, 'columns')}/part={run_stamp(at)}"


def summarise_days(spark: SparkSession, layout: Layout, at: datetime) -> None:
    """Count nulls and copies of the transaction days that changed since they were counted last."""
    adopt_bronze(spark, layout, "transactions")
    log = pending(spark, layout, "transactions", CHECKS)
    days, parts = days_of(log), parts_of(log)
    if days:
        bronze = on_days(scan_bronze(spark, layout, "transactions"), days)
        write_days(day_checks(bronze), layout.qa("transactions", "days"), run_stamp(at))
    take(spark, layout, "transactions", CHECKS, parts)


def transaction_checks_between(spark: SparkSession, layout: Layout, start: date | None = None,
                               end: date | None = None) -> DataFrame:
    """The checks of the days ``[start, end]``, or of all, added up from the counts per day.

    The column check fails if any file delivered so far lacked or added columns.
    """
    days = latest_days(spark, layout.qa("transactions", "days"))
    if days is None:
        days = spark.createDataFrame([], "utc_date date, null_rows bigint, duplicate_groups bigint, surplus_rows bigint")
    if start is not None and end is not None:
        days = within_dates(days, start, end)
    files = scan_if_present(spark, layout.qa("transactions", "columns"))
    bad = files is not None and not files.filter("all_cols_check = 'fail'").isEmpty()
    return merged_checks(days, conforming=F.lit(not bad))


def log_transaction_checks(spark: SparkSession, layout: Layout, at: datetime,
                           fmt: str = "parquet") -> None:
    """Add the result of the checks over all days, stamped ``at``, to their log; a rerun replaces it."""
    summarise_days(spark, layout, at)
    checks = transaction_checks_between(spark, layout)
    row = checks.select(F.lit(at.timestamp()).alias("date"), *checks.columns)
    overwrite_table(row, f"{layout.qa('transactions', 'checks')}/run={run_stamp(at)}", fmt)
