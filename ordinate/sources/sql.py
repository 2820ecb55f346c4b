"""Rows of a SQL query."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# Type names accepted for query columns and their Spark types.
SQL_TYPES = {
    "integer": "int", "int32": "int", "int64": "bigint", "double": "double", "float64": "double",
    "string": "string", "character": "string", "bool": "boolean",
}


@dataclass(frozen=True)
class SqlRecordSpec:
    names: tuple[str, ...]
    types: tuple[str, ...]


def sql_record_spec(names: Sequence[str], types: Sequence[str]) -> SqlRecordSpec:
    """Names and types for the columns of a query, by position."""
    if len(names) != len(types):
        raise ValueError("one type per name")
    wrong = [t for t in types if t not in SQL_TYPES]
    if wrong:
        raise ValueError(f"unsupported types {wrong}; use one of {sorted(SQL_TYPES)}")
    return SqlRecordSpec(tuple(names), tuple(types))


def sql_dataset(
    spark: SparkSession, query: str, record_spec: SqlRecordSpec | None = None,
    jdbc_url: str | None = None, properties: dict | None = None, predicates: list[str] | None = None,
) -> DataFrame:
    """A query's rows, renamed and typed by position.

    The query runs in Spark over tables and views, or in the database at ``jdbc_url``
    through a driver on the class path: one task for each of the ``predicates``, conditions that
    together hold for each row once, so that a large result is read by many.
    """
    if jdbc_url is None:
        rows = spark.sql(query)
    else:
        rows = spark.read.jdbc(jdbc_url, f"({query}) q", predicates=predicates, properties=properties or {})
    if record_spec is None:
        return rows
    if len(rows.columns) != len(record_spec.names):
        raise ValueError(f"the query has {len(rows.columns)} columns, the record spec {len(record_spec.names)}")
    renamed = rows.toDF(*record_spec.names)
    return renamed.select(*[F.col(f"`{n}`").cast(SQL_TYPES[t]) for n, t in zip(record_spec.names, record_spec.types)])
