"""Landing files to bronze, by stream or by date range.

Both record in the change log which file brought which day, and leave out what the other has loaded, so a
delivery that goes through both is in bronze once.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.incremental import within_dates
from millrace.operators.snapshots import latest_per_key
from millrace.sources.changes import (
    FILE, LANDED, RANGED, adopt_bronze, not_loaded_by, record_changes, with_file,
)
from millrace.sources.layout import Layout
from millrace.sources.schemas import BRONZE_SCHEMAS, SNAPSHOT_KEYS
from millrace.sources.sinks import overwrite_table, replace_partitions
from millrace.sources.tables import ABSENT_CONDITIONS

# Bounds one micro-batch, so that a large backlog is loaded in restartable steps.
MAX_BYTES_PER_BATCH = 1024 ** 4
# Spark drops files a week older than the newest; a delivery that keeps old times must not be lost.
MAX_FILE_AGE = "36500d"


def landing_stream(spark: SparkSession, layout: Layout, name: str,
                   max_bytes: int = MAX_BYTES_PER_BATCH) -> DataFrame | None:
    """Files delivered for a table, as a stream with the declared schema; None before the first delivery."""
    try:
        return (spark.readStream.schema(BRONZE_SCHEMAS[name])
                .option("recursiveFileLookup", "true")
                .option("maxBytesPerTrigger", max_bytes)
                .option("maxFileAge", MAX_FILE_AGE)
                .parquet(layout.landing(name)))
    except AnalysisException as error:
        if error.getCondition() in ABSENT_CONDITIONS:
            return None
        raise


def ingest_landing(spark: SparkSession, layout: Layout, name: str,
                   max_bytes: int = MAX_BYTES_PER_BATCH) -> None:
    """Load files not loaded before into bronze, then stop. Nothing delivered, nothing done.

    The checkpoint remembers the files, so nothing depends on dates: files with old days are
    loaded too. Each batch has a folder of its own, and a part of its own in the change log, so a batch
    that is repeated after a failure replaces what it wrote before. Rows are rebalanced by day: few files
    per day and batch, a large day over several tasks.
    """
    def write_batch(rows: DataFrame, batch_id: int) -> None:
        fresh = not_loaded_by(RANGED, rows, layout, name)
        overwrite_table(fresh.drop(FILE), f"{layout.landed(name)}/batch_id={batch_id}", by="utc_date")
        record_changes(fresh, layout, name, LANDED, str(batch_id))

    adopt_bronze(spark, layout, name)
    stream = landing_stream(spark, layout, name, max_bytes)
    if stream is None:
        return
    (with_file(stream)
     .writeStream.foreachBatch(write_batch)
     .option("checkpointLocation", layout.checkpoint(name))
     .trigger(availableNow=True)
     .start()
     .awaitTermination())


def landing_files(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """Everything delivered for a table, as a batch; None before the first delivery."""
    try:
        return (spark.read.schema(BRONZE_SCHEMAS[name])
                .option("recursiveFileLookup", "true").parquet(layout.landing(name)))
    except AnalysisException as error:
        if error.getCondition() in ABSENT_CONDITIONS:
            return None
        raise


def ingest_range(spark: SparkSession, layout: Layout, name: str, start: date, end: date) -> None:
    """Load the days ``[start, end]``, replacing what was loaded for them before by date range."""
    adopt_bronze(spark, layout, name)
    files = landing_files(spark, layout, name)
    if start > end or files is None:
        return
    fresh = not_loaded_by(LANDED, within_dates(with_file(files), start, end), layout, name)
    replace_partitions(fresh.drop(FILE), layout.ranged(name), by="utc_date")
    record_changes(fresh, layout, name, RANGED, f"{start}_{end}")


def snapshot_of(files: DataFrame, name: str) -> DataFrame:
    """Per key the row of the file delivered last (modification time, then path)."""
    delivery = files.withColumns({"_at": F.col("_metadata.file_modification_time"), FILE: F.col("_metadata.file_path")})
    latest = latest_per_key(delivery, SNAPSHOT_KEYS[name], F.col("_at"), F.col(FILE))
    return latest.drop("_at", FILE)


def ingest_snapshot(spark: SparkSession, layout: Layout, name: str, fmt: str = "parquet") -> None:
    """Replace a snapshot table by the latest row of every key delivered for it.

    Deliveries pile up in landing; a key that a later one repeats is taken from there, one that it leaves out
    stays, so sales of products no longer listed keep their price. Before the first delivery the
    table is empty.
    """
    files = landing_files(spark, layout, name)
    rows = (spark.createDataFrame([], BRONZE_SCHEMAS[name]) if files is None else snapshot_of(files, name))
    overwrite_table(rows, layout.table("bronze", name), fmt)
