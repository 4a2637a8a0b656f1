"""The whole daily run: landing to bronze, checks, silver, gold, report."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.completeness import MAX_FAILING_DAYS, THRESHOLD
from millrace.operators.incremental import date_bounds
from millrace.operators.report import order_report
from millrace.plans.loads import (
    finish_report, load_clickstream, load_products, load_transactions, load_users, mark_of, refresh_gold,
)
from millrace.plans.quality import (
    check_delivered_columns, counts_of_days, first_failing_day, log_history, log_transaction_checks,
    repair_clickstream,
)
from millrace.plans.state import State, Steps, record, state_of
from millrace.session import require_settings
from millrace.sources.changes import days_of, parts_of, pending, take
from millrace.sources.layout import Layout, run_stamp
from millrace.sources.schemas import FACT_TABLES, SNAPSHOT_TABLES
from millrace.sources.sinks import overwrite_table
from millrace.sources.tables import scan_bronze, scan_table
from millrace.streaming.landing import ingest_landing, ingest_snapshot

SILVER = "silver"  # as a consumer of the change log
REPORT_SCHEMA = ("product_name string, year int, aliased_month string, total_sales decimal(18,2), "
                 "MoM_growth decimal(18,2), MoM_pct_growth decimal(18,2)")


@dataclass(frozen=True)
class PipelineConfig:
    layout: Layout
    run_at: datetime
    control: DataFrame | None = None       # expected totals; None leaves the click check out
    attempts: Sequence[str] = field(default_factory=tuple)
    threshold: float = THRESHOLD
    max_failing_days: int = MAX_FAILING_DAYS
    product_id: str | None = None
    as_of: date | None = None
    fmt: str = "parquet"                   # of snapshot, silver, gold, QA and report tables


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """Run every step once and return the report saved under the run's stamp.

    What changed in bronze since the last finished run decides what is loaded: days of new deliveries, late
    ones and repaired ones alike. Days at or before a table's mark are logged as late. Silver is
    rewritten for the changed days, gold from the earliest of them on. A table nothing was delivered for is
    left out; without transactions the report is empty.

    Steps are recorded as they finish. A run that died is started again with the same ``run_at`` and goes on
    after its last finished step; a finished run returns its report.
    """
    layout, fmt, at = config.layout, config.fmt, config.run_at
    require_settings(spark)
    steps = Steps(spark, layout, at)
    for name in SNAPSHOT_TABLES:
        steps.once(f"snapshot_{name}", partial(ingest_snapshot, spark, layout, name, fmt))
    for name in FACT_TABLES:
        steps.once(f"columns_{name}", partial(check_delivered_columns, spark, layout, name, at))
        steps.once(f"ingest_{name}", partial(ingest_landing, spark, layout, name))
        steps.once(f"late_{name}", partial(log_late_days, spark, config, name))

    if config.control is not None:
        steps.once("clicks", partial(check_clicks, spark, config))
    present = [name for name in FACT_TABLES if has_bronze(spark, layout, name)]
    # Parts and days are taken down now: what arrives while silver is written is left to the next run.
    changed = {name: pending(spark, layout, name, SILVER) for name in present}
    parts = {name: parts_of(log) for name, log in changed.items()}
    days = {name: days_of(log) for name, log in changed.items()}

    steps.once("users", partial(load_users, spark, layout, at, fmt))
    steps.once("products", partial(load_products, spark, layout, at, fmt))
    if "clickstream" in present:
        steps.once("silver_clickstream", partial(load_clickstream, spark, layout, at, fmt=fmt, days=days["clickstream"]))
    if "transactions" in present:
        steps.once("checks", partial(log_transaction_checks, spark, layout, at, fmt))
        steps.once("silver_transactions", partial(load_transactions, spark, layout, at, fmt=fmt, days=days["transactions"]))
        steps.once("gold", partial(refresh_gold, spark, layout, day_before(days["transactions"]), fmt))
        steps.once("report", partial(finish_report, spark, layout, run_stamp(at), config.product_id, config.as_of, fmt))
    steps.once("marks", partial(finish, spark, config, parts, days))
    if "transactions" not in present:
        return spark.createDataFrame([], REPORT_SCHEMA)
    return order_report(scan_table(spark, layout.report(run_stamp(at)), fmt))


def day_before(days: Iterable[date | None]) -> date | None:
    """The day before the earliest; None where there is none."""
    dated = [day for day in days if day is not None]
    return min(dated) - timedelta(days=1) if dated else None


def finish(spark: SparkSession, config: PipelineConfig, parts: dict[str, list[tuple]],
           days: dict[str, list[date | None]]) -> None:
    """Record marks and the parts that silver now holds. Repeated after a failure, it changes nothing."""
    layout, checked_to = config.layout, config.run_at.date() - timedelta(days=1)
    for name in FACT_TABLES:
        before = state_of(spark, layout, name)
        reached = [day for day in [before.loaded_to, *days.get(name, [])] if day is not None]
        checked = name == "clickstream" and config.control is not None
        record(spark, layout, name, config.run_at, State(max(reached, default=None), checked_to if checked else None))
        take(spark, layout, name, SILVER, parts.get(name, []))


def has_bronze(spark: SparkSession, layout: Layout, name: str) -> bool:
    try:
        scan_bronze(spark, layout, name)
    except FileNotFoundError:
        return False
    return True


def log_late_days(spark: SparkSession, config: PipelineConfig, name: str) -> None:
    """Keep the days at or before the mark that deliveries since the last finished run brought rows of."""
    mark = mark_of(spark, config.layout, name, config.fmt)
    if mark is not None:
        late = (pending(spark, config.layout, name, SILVER).filter(F.col("utc_date") <= F.lit(mark))
                .groupBy("utc_date").agg(F.sum("rows").alias("late_rows")))
        overwrite_table(late, f"{config.layout.qa(name, 'late')}/{run_stamp(config.run_at)}", config.fmt)


def check_clicks(spark: SparkSession, config: PipelineConfig) -> None:
    """Check, and repair where possible, every day up to the day before the run.

    The first day is the one after the last checked, else after the loaded ones, else the first one with
    expected totals; with refetches at hand it is the earliest day that still fails, however long ago it was
    checked. Days without a single click are checked like others.
    """
    layout, end = config.layout, config.run_at.date() - timedelta(days=1)
    checked = state_of(spark, layout, "clickstream").checked_to or mark_of(spark, layout, "clickstream", config.fmt)
    start = (date_bounds(config.control).first()["min_date"] if checked is None
             else checked + timedelta(days=1))
    if config.attempts:
        counts_of_days(spark, layout, config.run_at, f"r{run_stamp(config.run_at)}")
        failing = first_failing_day(spark, layout, config.control, end, config.threshold)
        start = min((day for day in (start, failing) if day is not None), default=None)
    if start is not None and start <= end:
        repair_clickstream(spark, layout, config.control, start, end, config.run_at,
                           config.attempts, config.threshold, config.max_failing_days, config.fmt)
        log_history(spark, layout, config.control, config.threshold, config.fmt)
