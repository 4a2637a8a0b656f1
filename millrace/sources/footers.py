"""Schemas of delivered Parquet files, read from their footers in parallel."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.tables import ABSENT_CONDITIONS

FOOTERS = "file string, rows bigint, columns array<string>"


def delivered_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder (``file``, as ``_metadata.file_path`` names it); their contents are not read."""
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException as error:
        if error.getCondition() in ABSENT_CONDITIONS:
            return spark.createDataFrame([], "file string, path string")
        raise
    return listed.select(F.col("_metadata.file_path").alias("file"), "path")


def opened(path: str) -> pa.NativeFile:
    """A file of any store ``pyarrow.fs`` knows: local, hdfs, s3, gs."""
    system, inner = arrow_fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(inner)


def file_columns(files: DataFrame) -> DataFrame:
    """``file, rows, columns`` of Parquet files. Tasks read footers only, as many files as a task was dealt."""
    schema = pa.schema([("file", pa.string()), ("rows", pa.int64()), ("columns", pa.list_(pa.string()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for file, path in zip(batch["file"].to_pylist(), batch["path"].to_pylist()):
                with opened(path) as source:
                    footer = pq.ParquetFile(source)
                    found.append({"file": file, "rows": footer.metadata.num_rows,
                                  "columns": footer.schema_arrow.names})
            yield pa.RecordBatch.from_pylist(found, schema=schema)

    return files.select("file", "path").mapInArrow(read, FOOTERS)
