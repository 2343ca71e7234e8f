"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import scratch_path

#: Rows and bytes that one Arrow batch hands to a Python worker at most: bounds its memory when texts are long.
BATCH_ROWS, BATCH_BYTES = 4000, "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python workers get small batches in this session from now on (plans are lazy, so it stays set)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh table below the shared folder and read it back: cuts the lineage so that a lost
    executor can't renumber rows, and lets several steps read one result."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def importable(spark: SparkSession) -> None:
    """Python workers on the driver's disk find this package wherever the driver started (a cluster has --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


#: In a Python worker: the step it works for, and what that step keeps between its tasks.
_kept: dict = {"step": None}


def keep(name: str, make: Callable):
    """What ``make`` gives, made once a worker and step; it goes when the worker turns to another step."""
    if name not in _kept:
        _kept[name] = make()
    return _kept[name]


def _turn_to(step: str) -> None:
    """Workers serve one operator after the other: drop what the last one kept."""
    if _kept["step"] != step:
        _kept.clear()
        _kept["step"] = step


def _give_back() -> None:
    """Freed memory goes back to the system, so that a worker between two tasks is small."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    small_batches(df.sparkSession)
    importable(df.sparkSession)
    step = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _turn_to(step)
        yield from fn(batches)
        _give_back()

    return df.mapInArrow(run, schema)
