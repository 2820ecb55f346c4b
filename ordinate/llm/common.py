"""Helpers of the operators: tables, scratch tables, Arrow text, values kept per process."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ordinate.scratch import scratch_path

#: Bytes of text that vectorised code holds at a time; a longer text is one piece.
PIECE = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, what: str, partition_by: list[str] | None = None) -> tuple[DataFrame, Callable[[], None]]:
    """The rows as a table in the shared folder, and a function that removes it after its last use."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, what)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)

    def drop() -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    return spark.read.schema(df.schema).parquet(path), drop


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """From now on, let Python workers get rows in batches of so many bytes: texts are long, and both sides hold a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def release(spark: SparkSession) -> None:
    """Have Spark remove shuffle files of steps that are over, which else wait for the driver's garbage collection."""
    gc.collect()
    spark._jvm.System.gc()


def per_process(key: str, make: Callable[[], object]) -> object:
    """A value made once per Python process, so that tasks that follow each other share it.

    The key's first word names its operator.  A process keeps the values of one operator: those of another that
    ran before go, so that a worker that serves one stage after the other does not fill up.
    """
    kept = sys.modules.setdefault("_ordinate_llm_kept", types.ModuleType("_ordinate_llm_kept")).__dict__
    owner = key.split(" ")[0]
    if kept.get("owner") != owner:
        kept.clear()
        kept["owner"] = owner
    if key not in kept:
        kept[key] = make()
    return kept[key]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes in one array, and the bounds of its texts there.  A null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind, n = (np.int64 if wide else np.int32), len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def pieces(batch: pa.RecordBatch, text: str, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most so many bytes of text, or of one row."""
    _, bounds = utf8(batch.column(text))
    start, n = 0, batch.num_rows
    while start < n:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + most, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop
