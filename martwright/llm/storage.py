"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
# Arrow batches are bounded in bytes as well as rows, so that long texts don't pile up in a worker.
_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where that is unset, a folder of its own on one machine, and an error on a cluster."""
    folder = spark.conf.get(_SETTING, None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {_SETTING} to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="martwright-")
        spark.conf.set(_SETTING, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: a lost executor costs the tasks it ran, never what was written. The
    folder is the caller's to clear; results are lazy, so the operators can't.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, unless the user has set other bounds."""
    defaults = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": None}
    for key, value in _BATCHES.items():
        if spark.conf.get(key, None) in (defaults[key], None, "-1", str(2**63 - 1), str(2**31 - 1)):
            spark.conf.set(key, value)


Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(rows: Rows) -> Rows:
    """``rows`` for ``mapInArrow``, after which its worker gives back the memory it no longer uses.

    Workers outlive their tasks, and two of them stand beside each executor's heap: what a stage has held, its caches and tables, would
    count for all later stages.
    """

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from rows(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # not that C library
            pass

    return out
