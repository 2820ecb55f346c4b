"""Flat map by a table function: opaque Python that makes any number of rows, also callable in SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from ordinate.order import as_list


def table_function(produce: Callable[[Row], Iterable[tuple]], schema: str, finish: Callable | None = None, start: Callable | None = None):
    """A table function whose argument is a table: ``produce(row) -> rows``, for each of its rows.

    With ``start``, each partition has a state: ``start()`` makes it, ``produce(state, row)`` gets it before the row, and
    ``finish(state)`` gives the partition's last rows.  A call names the partitions and the order inside them,
    ``f(TABLE(t) PARTITION BY k ORDER BY o)``; a task holds one row and one state of them, whatever their size.
    """
    if finish is not None and start is None:
        raise ValueError("finish needs a state, which start makes")

    class Function:
        def __init__(self):
            self.state = start() if start else None
            self.begun = False

        def eval(self, row: Row):
            self.begun = True
            yield from produce(row) if start is None else produce(self.state, row)

        def terminate(self):
            if self.begun and finish is not None:
                yield from finish(self.state)

    return udtf(Function, returnType=schema)


def row_function(produce: Callable[..., Iterable[tuple]], schema: str | Callable[..., T.StructType]):
    """A table function of values, for ``t, LATERAL f(t.a, t.b)``: ``produce(a, b) -> rows``.

    ``schema`` may be a function of the arguments' types; it is asked when the query is analyzed.
    """
    if not callable(schema):
        class Function:
            def eval(self, *values):
                yield from produce(*values)

        return udtf(Function, returnType=schema)

    from pyspark.sql.udtf import AnalyzeResult

    class Typed:
        @staticmethod
        def analyze(*arguments) -> AnalyzeResult:
            return AnalyzeResult(schema=schema(*[a.dataType for a in arguments]))

        def eval(self, *values):
            yield from produce(*values)

    return udtf(Typed)


def register_functions(spark: SparkSession, functions: Mapping[str, object]) -> None:
    """Make table functions known to the session's SQL, by name."""
    for name, function in functions.items():
        spark.udtf.register(name, function)


def flat_map_table(df: DataFrame, function, partition_by=None, order_by=None) -> DataFrame:
    """The rows that a :func:`table_function` makes from a DataFrame's rows.

    With ``partition_by`` rows of equal keys reach one call, in the order of ``order_by``.  Without it each of the
    DataFrame's partitions is mapped where it is, so that only functions without a state make sense.
    """
    if partition_by is None:
        if order_by is not None:
            raise ValueError("order_by needs partition_by: there is no order over all rows here")
        # a table argument without partitions would go to one task: call the function beside each row instead
        whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
        return whole.lateralJoin(function(F.col("row").outer())).drop("row")
    table = df.asTable().partitionBy(*as_list(partition_by))
    return function(table.orderBy(*as_list(order_by)) if order_by is not None else table)
