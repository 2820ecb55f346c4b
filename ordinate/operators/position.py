"""Operators that depend on where a row stands in the sequence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ordinate.operators.mapping import as_condition
from ordinate.order import (
    BUCKET, OrderIndex, Ordinal, as_list, before_key, build_index, comparable, from_key, key_at, key_types, require_batch, require_new, with_ordinal, _pack,
)


def enumerate_rows(df: DataFrame, order_by, start: int = 0, name: str = "index") -> DataFrame:
    """Number the rows in order, from ``start``, as a bigint column."""
    require_new(df, name)
    return with_ordinal(df, order_by, name, start=start)


def take(df: DataFrame, count: int, order_by) -> DataFrame:
    """The first ``count`` rows, in no order; -1 takes them all.

    Finds the key of the first row to leave and filters on it, so rows are neither moved nor sorted.
    """
    require_batch(df, "take")
    if count < 0:
        return df
    if isinstance(order_by, Ordinal):
        return df.where(F.col(order_by) < count)
    index, bound = key_at(df, order_by, count)
    return df if bound is None else df.where(before_key(df, index, bound))


def skip(df: DataFrame, count: int, order_by) -> DataFrame:
    """Everything after the first ``count`` rows; -1 skips them all.

    Finds the key of the first row to keep and filters on it, so rows are neither
    moved nor ranked and Parquet can leave out whole row groups.
    """
    require_batch(df, "skip")
    if count < 0:
        return df.where(F.lit(False))
    if count == 0:
        return df
    if isinstance(order_by, Ordinal):
        return df.where(F.col(order_by) >= count)
    index, bound = key_at(df, order_by, count)
    return df.where(F.lit(False)) if bound is None else df.where(from_key(df, index, bound))


def take_while(df: DataFrame, predicate, order_by) -> DataFrame:
    """Rows before the first one that fails the predicate (null fails).

    One aggregate over the predicate's and order's columns finds where to stop.
    """
    require_batch(df, "take_while")
    names = as_list(order_by)
    key = _pack([comparable(df, c) for c in names])
    fails = ~F.coalesce(as_condition(df, predicate), F.lit(False))
    stop = df.where(fails).agg(F.min(key).alias("stop")).first()["stop"]
    if stop is None:
        return df
    index = OrderIndex(tuple(names), (), key_types(df, names), [], {"n": []}, 0, 1)
    here = from_key(df, index, tuple(stop)) & (key <= index.key_literal(tuple(stop)))
    if len(df.where(here).select(F.lit(1)).limit(2).collect()) > 1:
        raise ValueError(f"{names} do not order the rows: {tuple(stop)} stands twice")
    return df.where(before_key(df, index, tuple(stop)))


def shard(df: DataFrame, num_shards: int, index: int, order_by) -> DataFrame:
    """Every ``num_shards``-th row, beginning with row ``index``."""
    if not 0 <= index < num_shards:
        raise ValueError(f"index must be in [0, {num_shards}), got {index}")
    ranked = with_ordinal(df, order_by, "__ord")
    return ranked.where(F.pmod(F.col("__ord"), F.lit(num_shards)) == index).drop("__ord")


def repeat(df: DataFrame, count: int, name: str = "epoch") -> DataFrame:
    """``count`` copies of the rows; ``name`` holds the copy's number.

    The repeated sequence is ordered by ``name`` and then the input's order.  The
    endless form has no table; ask for as many epochs as are needed.
    """
    if count is None or count < 0:
        raise ValueError("an endless repeat cannot be a table; give a count")
    require_new(df, name)
    if count == 0:
        return df.withColumn(name, F.lit(0)).where(F.lit(False))
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def concatenate(*dfs: DataFrame, name: str = "source_id") -> DataFrame:
    """All rows of each input in turn; ``name`` numbers the input they came from.

    Inputs must have the same columns and types.  The result is ordered by
    ``name`` and then each input's order.
    """
    require_new(dfs[0], name)
    first = dfs[0].schema
    kinds = {f.name: f.dataType for f in first.fields}
    for other in dfs[1:]:
        if {f.name: f.dataType for f in other.schema.fields} != kinds:
            raise TypeError(f"cannot concatenate {other.schema.simpleString()} to {first.simpleString()}")
    return reduce(DataFrame.unionByName, [d.withColumn(name, F.lit(i)) for i, d in enumerate(dfs)])


def zip_datasets(*inputs: tuple[DataFrame, object], name: str = "ord") -> DataFrame:
    """Pair the rows of several ``(df, order_by)`` inputs by position.

    Element ``i`` of the result has structs ``_0``, ``_1``, ... of the inputs' row
    ``i``; it ends with the shortest input.
    """
    if len(inputs) < 2:
        raise ValueError("zip needs at least two inputs")
    columns = [df.columns for df, _ in inputs]
    if any(isinstance(order_by, Ordinal) for _, order_by in inputs):
        sides, on = [with_ordinal(df, order_by, name + "__") for df, order_by in inputs], [name + "__"]
    else:
        # cut every input at the same positions: rows that pair up are in the same
        # partition once ranked, and the join moves nothing
        indexes = [build_index(df, order_by) for df, order_by in inputs]
        cuts = indexes[0].starts
        sides = [ix.cut_at(df, cuts).ranked(df, name + "__") for ix, (df, _) in zip(indexes, inputs)]
        on = [BUCKET, name + "__"]
    packed = [
        side.select(*on, F.struct(*[F.col(f"`{c}`") for c in cols]).alias(f"_{i}"))
        for i, (side, cols) in enumerate(zip(sides, columns))
    ]
    return reduce(lambda a, b: a.join(b, on), packed).withColumnRenamed(name + "__", name).drop(BUCKET)
