"""Listing files and reading many of them as one sequence."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordinate.functions.hashing import seeded_hash
from ordinate.operators.combine import interleave


def file_list(spark: SparkSession, file_pattern, shuffle: bool = True, seed: int = 0) -> DataFrame:
    """Paths that match a glob, with their byte ``length`` and a ``rank``.

    ``rank`` orders the files: by seeded hash when ``shuffle``, else by name.  Only
    names and sizes are listed; no file is opened.
    """
    patterns = [file_pattern] if isinstance(file_pattern, str) else list(file_pattern)
    statuses = [status for pattern in patterns for status in _listed(spark, pattern)]
    found = spark.createDataFrame([(s.getPath().toString(), s.getLen()) for s in statuses], "path string, length bigint")
    return found.withColumn("rank", seeded_hash(seed, "path").cast("string") if shuffle else F.col("path"))


def _listed(spark: SparkSession, pattern: str) -> list:
    """Files that match, also empty ones; of a directory, those in it that are not hidden."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    files = []
    for status in system.globStatus(glob) or []:
        inside = system.listStatus(status.getPath()) if status.isDirectory() else [status]
        files.extend(s for s in inside if not s.isDirectory() and s.getPath().getName()[0] not in "._")
    return files


def read_files(
    spark: SparkSession,
    files,
    reader: Callable[[SparkSession, list[str]], DataFrame],
    num_shards: int | None = None,
    shard_index: int | None = None,
    parallel_files: int | None = None,
    parallel_interleave: int = 1,
    order_in_file=None,
    path_column: str = "path",
) -> DataFrame:
    """Read a glob, a list of paths or a DataFrame of paths with one ``reader`` call.

    The files' order is the list's, by ``rank`` in a DataFrame that has one (see
    :func:`file_list`), else by name.  ``num_shards`` and ``shard_index`` (from 0) keep every
    so many files in that order.  With ``parallel_files`` the rows get the order of taking
    ``parallel_interleave`` rows in turn from that many open files; the reader must
    then return ``path_column`` and the ``order_in_file`` columns.
    """
    if isinstance(files, str):
        files = file_list(spark, files, shuffle=False)
    if isinstance(files, DataFrame):  # names only; the reader takes them as a list
        order = ["rank", "path"] if "rank" in files.columns else ["path"]
        paths = [r["path"] for r in files.select(*order).distinct().orderBy(*order).collect()]
    else:
        paths = list(files)
    if (num_shards is None) != (shard_index is None):
        raise ValueError("give both num_shards and shard_index, or neither")
    if num_shards is not None:
        if not 0 <= shard_index < num_shards:
            raise ValueError(f"shard_index must be in [0, {num_shards}), got {shard_index}")
        paths = paths[shard_index::num_shards]
    if not paths:
        raise ValueError("no files to read")
    rows = reader(spark, paths)
    if parallel_files is None:
        return rows
    return interleave(
        rows, path_column, order_in_file, cycle_length=parallel_files, block_length=parallel_interleave,
        sources=[_qualified(spark, p) for p in paths])


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as Spark names it beside the rows of its file."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    named = make(path)
    whole = named.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(named).toString()
    return make(whole).toUri().toString()
