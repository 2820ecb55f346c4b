"""Row-wise operators: project, filter, explode, prepare.

The functions given to these operators build Column expressions, which stay in
generated code.  ``map_pandas`` is the way in for opaque Python, in Arrow batches.
All of them work on streams too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ordinate.functions.selectors import Selector, parse_formula, resolve


def as_condition(df: DataFrame, predicate) -> Column:
    """A predicate given as SQL text, a Column, or a function of the DataFrame."""
    if isinstance(predicate, str):
        return F.expr(predicate)
    return predicate(df) if callable(predicate) and not isinstance(predicate, Column) else predicate


def as_column(df: DataFrame, value) -> Column:
    """Like :func:`as_condition`, but plain text names a column or a SQL expression."""
    if isinstance(value, str):
        return F.col(f"`{value}`") if value in df.columns else F.expr(value)
    return value(df) if callable(value) and not isinstance(value, Column) else value


def map_rows(df: DataFrame, columns, keep: bool = False) -> DataFrame:
    """Compute new columns from each row.

    ``columns`` maps names to expressions, or is a function of the DataFrame that
    returns such a mapping.  ``keep`` adds to the row instead of replacing it.
    """
    made = columns(df) if callable(columns) else columns
    made = {name: as_column(df, value) for name, value in made.items()}
    return df.withColumns(made) if keep else df.select(*[c.alias(n) for n, c in made.items()])


def map_pandas(df: DataFrame, func, schema) -> DataFrame:
    """Apply ``func(pandas frame) -> pandas frame`` to Arrow batches of rows."""

    def run(batches):
        for batch in batches:
            yield func(batch)

    return df.mapInPandas(run, schema)


def filter_rows(df: DataFrame, predicate) -> DataFrame:
    """Keep rows where the predicate is true; null counts as false."""
    return df.where(as_condition(df, predicate))


def flat_map(df: DataFrame, elements, name: str = "element", position: str = "pos", keep_empty: bool = False) -> DataFrame:
    """Turn each row into one row per item of an array expression.

    The items of a row keep their place in ``position``, so the flattened sequence
    is ordered by the input's order columns and then ``position``.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return df.select("*", explode(as_column(df, elements)).alias(position, name))


def map_and_batch(df: DataFrame, columns, batch_size: int, order_by, drop_remainder: bool = False) -> DataFrame:
    """``map_rows`` followed by ``batch``; Spark fuses the projection into the scan."""
    from ordinate.operators.batching import batch
    from ordinate.order import as_list

    made = columns(df) if callable(columns) else dict(columns)
    hidden = {f"__order_{i}": F.col(f"`{c}`") for i, c in enumerate(as_list(order_by))}
    mapped = map_rows(df, {**hidden, **made})
    order = type(order_by)("__order_0") if isinstance(order_by, str) else list(hidden)
    return batch(mapped, batch_size, order, drop_remainder, columns=list(made))


def prepare(
    df: DataFrame,
    x,
    y: str | Selector | None = None,
    named: bool = True,
    named_features: bool = False,
    batch_size: int | None = None,
    order_by=None,
    drop_remainder: bool = False,
) -> DataFrame:
    """Split named columns into features ``x`` and a response ``y``.

    ``x`` is a formula (``"y ~ a + b"``), a selector, or a list.  Features become a
    struct when ``named_features``, otherwise one array, which needs equal types.
    ``y`` is left out when there is no response.  ``named=False`` gives positional
    names ``_0`` and ``_1``.  With ``batch_size`` the rows are batched as well.
    """
    if isinstance(x, str) and "~" in x:
        features, response = parse_formula(x, df.columns)
    else:
        features, response = resolve(df.schema, x), None
    if response is None and y is not None:
        found = resolve(df.schema, y)
        if len(found) > 1:
            raise ValueError(f"more than one response column: {found}")
        response = found[0] if found else None
    if not features:
        raise ValueError("no feature columns selected")
    if named_features:
        stacked = F.struct(*[F.col(f"`{c}`") for c in features])
    else:
        kinds = {df.schema[c].dataType.simpleString() for c in features}
        if len(kinds) > 1:
            raise TypeError(f"stacked features need one type, found {sorted(kinds)}; use named_features=True")
        stacked = F.array(*[F.col(f"`{c}`") for c in features])
    made = {"x" if named else "_0": stacked}
    if response is not None:
        made["y" if named else "_1"] = F.col(f"`{response}`")
    if batch_size is None:
        return df.select(*[c.alias(n) for n, c in made.items()])
    if order_by is None:
        raise ValueError("batching needs order_by")
    return map_and_batch(df, made, batch_size, order_by, drop_remainder)
