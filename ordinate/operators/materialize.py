"""Keeping and taking out results."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql.utils import AnalysisException

from ordinate.order import as_list

# Accepted compression names and their Parquet codecs.
CODECS = {"AUTO": "snappy", "GZIP": "gzip", "SNAPPY": "snappy", "None": "none", "": "none", None: "none"}


def cache(df: DataFrame, path: str | None = None) -> DataFrame:
    """Keep the rows: in executor memory and disk, or in files at ``path``.

    Blocks lost with an executor are recomputed; files at ``path`` outlive the session.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK) if path is None else snapshot(df, path)


def snapshot(
    df: DataFrame,
    path: str,
    compression: str | None = "AUTO",
    shard_func: Callable[[DataFrame], Column] | Column | None = None,
    reader_func: Callable[[DataFrame], DataFrame] | None = None,
    fingerprint: str | None = None,
) -> DataFrame:
    """Write the rows to ``path`` once and read them from there ever after.

    A snapshot counts only when its writing finished, and it records the schema and
    the ``fingerprint`` of what made it (any text, such as a version); a path that
    holds something else is an error, not silently reused.  ``shard_func`` gives the
    directory a row goes to and ``reader_func`` changes how the rows are read back.
    """
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {sorted(map(str, CODECS))}")
    spark = df.sparkSession
    data, note = f"{path.rstrip('/')}/data", f"{path.rstrip('/')}/made_of"
    made_of = hashlib.sha256(json.dumps([df.schema.jsonValue(), fingerprint], sort_keys=True).encode()).hexdigest()
    found = _read_note(spark, note)
    if found is not None and found != made_of:
        raise ValueError(f"{path} holds a snapshot of other data; choose another path")
    if found is None:
        out, writer_cols = df, []
        if shard_func is not None:
            name = "shard"
            while name in df.columns:  # the data's own columns stay as they are
                name = f"_{name}"
            out = df.withColumn(name, shard_func(df) if callable(shard_func) and not isinstance(shard_func, Column) else shard_func)
            writer_cols = [name]
        out.write.mode("overwrite").partitionBy(*writer_cols).option("compression", CODECS[compression]).parquet(data)
        # written last: without it the data directory is unfinished and is written again
        spark.createDataFrame([(made_of,)], "made_of string").coalesce(1).write.mode("overwrite").parquet(note)
    rows = spark.read.parquet(data)
    return reader_func(rows) if reader_func else rows.select(*df.columns)


def _read_note(spark: SparkSession, note: str) -> str | None:
    try:
        return spark.read.schema("made_of string").parquet(note).first()["made_of"]
    except (AnalysisException, TypeError):
        return None


def collect(df: DataFrame, order_by, iter_max: int) -> list[Row]:
    """The first ``iter_max`` rows in order, on the driver."""
    if iter_max is None or iter_max == float("inf"):
        raise ValueError("say how many rows the driver may hold")
    return df.orderBy(*as_list(order_by)).limit(int(iter_max)).collect()


def single_element(df: DataFrame) -> Row:
    """The only row; anything else is an error."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("expected exactly one element, found " + ("none" if not rows else "more"))
    return rows[0]
