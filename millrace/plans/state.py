"""What runs have done: marks of finished runs, steps of unfinished ones, counts per day.

All are small append-only logs beside the tables. A run records its marks after everything else succeeded;
its steps as they finish, so that a rerun of the same run goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.changes import read_log
from millrace.sources.layout import Layout
from millrace.sources.sinks import append_rows, overwrite_table
from millrace.sources.tables import scan_if_present

STATE_SCHEMA = "run_at timestamp, loaded_to date, checked_to date"
GOLD_SCHEMA = "recorded_at timestamp, loaded_to date, slot int"


@dataclass(frozen=True)
class State:
    loaded_to: date | None = None
    checked_to: date | None = None


def state_of(spark: SparkSession, layout: Layout, name: str) -> State:
    """The furthest any run got."""
    log = read_log(spark, layout.state(name), STATE_SCHEMA)
    if log is None:
        return State()
    return State(*log.agg(F.max("loaded_to"), F.max("checked_to")).first())


def record(spark: SparkSession, layout: Layout, name: str, at: datetime, state: State) -> None:
    row = spark.createDataFrame([(at, state.loaded_to, state.checked_to)], STATE_SCHEMA)
    append_rows(row.coalesce(1), layout.state(name))


@dataclass(frozen=True)
class GoldState:
    """Up to which day gold is written, and the slot that holds the last entries as of that day."""
    loaded_to: date
    slot: int


def gold_state(spark: SparkSession, layout: Layout) -> GoldState | None:
    log = read_log(spark, layout.state("gold"), GOLD_SCHEMA)
    row = None if log is None else log.agg(
        F.max_by(F.struct("loaded_to", "slot"), "recorded_at").alias("last")).first()["last"]
    return None if row is None or row["loaded_to"] is None else GoldState(row["loaded_to"], row["slot"])


def record_gold(spark: SparkSession, layout: Layout, state: GoldState) -> None:
    row = spark.createDataFrame([(datetime.now(timezone.utc), state.loaded_to, state.slot)], GOLD_SCHEMA)
    append_rows(row.coalesce(1), layout.state("gold"))


class Steps:
    """Steps of the run stamped ``at``; each is done once, however often the run is started."""

    def __init__(self, spark: SparkSession, layout: Layout, at: datetime):
        self.spark, self.layout, self.at = spark, layout, at

    def done(self, step: str) -> bool:
        return scan_if_present(self.spark, self.layout.step(self.at, step)) is not None

    def once(self, step: str, action: Callable[[], object]) -> None:
        if not self.done(step):
            action()
            marker = self.spark.createDataFrame([(datetime.now(timezone.utc),)], "finished_at timestamp")
            overwrite_table(marker.coalesce(1), self.layout.step(self.at, step))


def write_days(days: DataFrame, path: str, part: str) -> None:
    """Add counts per day to a log of them; a part that is written again replaces itself."""
    at = F.lit(datetime.now(timezone.utc))
    overwrite_table(days.withColumn("computed_at", at), f"{path}/part={part}")


def latest_days(spark: SparkSession, path: str) -> DataFrame | None:
    """The counts of every day as computed last; None where there are none yet."""
    log = scan_if_present(spark, path)
    if log is None:
        return None
    columns = [name for name in log.columns if name not in ("part", "computed_at", "utc_date")]
    return (log.groupBy("utc_date").agg(F.max_by(F.struct(*columns), F.struct("computed_at", F.col("part").cast("string")))
                                        .alias("counts"))
            .select("utc_date", "counts.*"))
