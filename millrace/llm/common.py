"""What the operators of this subpackage share: reading, scratch tables, Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
import resource
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_folder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: lineage is cut, and what was
    computed outlives lost executors. The path is new, so a repeated run never mixes with it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_KEPT: dict = {}


def kept(key, make: Callable):
    """What a worker process remembers from task to task: one thing at a time, so that memories of
    different operators don't add up."""
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Hand freed memory of this worker process back to the machine; allocators keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: nothing to trim


#: Resident size from which a worker process hands memory back between tasks and groups.
LARGE_WORKER = 320 << 20


def tidy(most: int = LARGE_WORKER) -> None:
    """Hand memory back if this worker has grown: idle workers beside busy ones keep what they hold."""
    try:
        with open("/proc/self/statm") as sizes:
            resident = int(sizes.read().split()[1]) * resource.getpagesize()
    except OSError:
        return  # another system: nothing to read
    if resident > most:
        give_back()


#: Bytes of rows that go to a Python worker at once; a single row may be larger.
BATCH_BYTES = 1 << 24


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Batches for Python workers end by bytes, not only by rows, so long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def whole_text(column: str = "text") -> "F.Column":
    """The text, null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def map_rows(df: DataFrame, schema: str, start: Callable[[], Callable], most: int = LARGE_WORKER) -> DataFrame:
    """Apply Python to Arrow batches. ``start`` runs once per task and gives a function from one
    batch to an iterable of columns dicts; with ``None`` it is called once more at the end. Workers of
    more than ``most`` bytes then hand memory back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, batch, columns = start(), None, None
        for batch in batches:
            for columns in step(batch):
                yield pa.RecordBatch.from_pydict(columns, schema=arrow)
        batch = None
        for columns in step(None):
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)
        del step, columns
        tidy(most)

    arrow = arrow_schema(df.sparkSession, schema)
    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))
