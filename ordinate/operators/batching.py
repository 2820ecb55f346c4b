"""Groups of consecutive rows: batches, padded batches, length buckets, windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ordinate.operators.mapping import as_column
from ordinate.order import BUCKET, Ordinal, Runs, as_list, build_index, require_batch, require_new, with_ordinal
from ordinate.scratch import written


def _gather(df: DataFrame, keys: Sequence, order: str, columns: Sequence[str], extra=()):
    """One row per group of ``keys``, and its array per column, items sorted by ``order``."""
    items = F.sort_array(F.collect_list(F.struct(F.col(order).alias("__at"), *[F.col(f"`{c}`") for c in columns])))
    out = df.groupBy(*keys).agg(items.alias("__items"), F.count(F.lit(1)).cast("int").alias("size"), *extra)
    arrays = [F.col("__items").getField(c).alias(c) for c in columns]
    return out, arrays


def batch(
    df: DataFrame,
    batch_size: int,
    order_by,
    drop_remainder: bool = False,
    columns: Sequence[str] | None = None,
    name: str = "batch_id",
) -> DataFrame:
    """Combine each ``batch_size`` consecutive rows into one row of arrays.

    The last batch may be short unless ``drop_remainder``.  The result has the
    batch's number, its ``size`` and one array per column, in order.
    """
    out, arrays = _batches(df, batch_size, order_by, drop_remainder, columns, name)
    return out.select(name, "size", *arrays)


def _batches(df, batch_size, order_by, drop_remainder, columns, name="batch_id"):
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    columns = list(columns or df.columns)
    # ranges cut at multiples of the batch size: a batch lies within one task already
    ranked = with_ordinal(df, order_by, "__ord", align=batch_size, keep_bucket=True)
    ranked = ranked.withColumn(name, F.expr(f"__ord div {int(batch_size)}"))
    keys = [BUCKET, name] if BUCKET in ranked.columns else [name]
    out, arrays = _gather(ranked, keys, "__ord", columns)
    if drop_remainder:
        out = out.where(F.col("size") == batch_size)
    return out, arrays


def summarize_batches(
    df: DataFrame, batch_size: int, order_by, aggregates: dict[str, Column],
    drop_remainder: bool = False, name: str = "batch_id",
) -> DataFrame:
    """Aggregate each batch directly, for when its rows are not wanted as arrays."""
    ranked = with_ordinal(df, order_by, "__ord", align=batch_size, keep_bucket=True)
    ranked = ranked.withColumn(name, F.expr(f"__ord div {int(batch_size)}"))
    keys = [BUCKET, name] if BUCKET in ranked.columns else [name]
    out = ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("size"), *[c.alias(n) for n, c in aggregates.items()]
    )
    if drop_remainder:
        out = out.where(F.col("size") == batch_size)
    return out.drop(BUCKET)


def unbatch(df: DataFrame, order_by, columns: Sequence[str] | None = None, name: str = "pos") -> DataFrame:
    """Split rows of equally long arrays back into one row per item.

    Keeps the order columns of the batch; the result is ordered by them and ``name``.
    Every other column must be an array, and all arrays of a row equally long.
    """
    order = as_list(order_by)
    columns = list(columns or [f.name for f in df.schema.fields
                               if isinstance(f.dataType, T.ArrayType) and f.name not in order])
    if not columns:
        raise ValueError("no array columns to split")
    sizes = F.array(*[F.size(f"`{c}`") for c in columns])
    checked = F.when(F.array_min(sizes) == F.array_max(sizes), F.arrays_zip(*[F.col(f"`{c}`") for c in columns])).otherwise(
        F.raise_error(F.lit("arrays of a batch differ in length"))
    )
    items = df.select(*order, F.posexplode(checked).alias(name, "__item"))
    return items.select(*order, name, *[F.col("__item")[c].alias(c) for c in columns])


def rebatch(
    df: DataFrame,
    batch_size: int | Sequence[int],
    order_by="batch_id",
    drop_remainder: bool = False,
    columns: Sequence[str] | None = None,
    name: str = "batch_id",
) -> DataFrame:
    """Cut a batched DataFrame into batches of other sizes.

    Several sizes are used in turn, over and over.
    """
    sizes = [batch_size] if isinstance(batch_size, int) else list(batch_size)
    if not sizes or min(sizes) < 1:
        raise ValueError("batch sizes must be at least 1")
    order = as_list(order_by)
    columns = list(columns or [f.name for f in df.schema.fields
                               if isinstance(f.dataType, T.ArrayType) and f.name not in order])
    cycle, ends = sum(sizes), [sum(sizes[:i + 1]) for i in range(len(sizes))]
    held = df.where(F.size(f"`{columns[0]}`") > 0).withColumn("__held", F.size(f"`{columns[0]}`").cast("bigint"))
    lengths = F.array(*[F.size(f"`{c}`") for c in columns])
    held = held.withColumn("__held", F.when(F.array_min(lengths) == F.array_max(lengths), F.col("__held")).otherwise(
        F.raise_error(F.lit("arrays of a batch differ in length"))))
    # items are counted by the batches' sizes; each batch is cut where a new one begins, and only the pieces come together
    index = build_index(held, order, measures={"weight": ("sum", F.col("__held"))}, runs=cycle)
    runs = index.in_runs(held, "__first", F.col("__held"))
    last = F.col("__first") + F.col("__held") - 1
    slot = lambda within: sum((F.when(within >= e, 1).otherwise(0) for e in ends[:-1]), F.lit(0)).cast("bigint")
    number = lambda at: F.floor(at / cycle).cast("bigint") * len(sizes) + slot(F.pmod(at, F.lit(cycle)))
    rows = runs.rows.withColumns({"__low": number(F.col("__first")), "__high": number(last)})
    rows = rows.withColumn(name, F.explode(F.sequence("__low", "__high")))
    turn, place = F.expr(f"`{name}` div {len(sizes)}") * cycle, F.pmod(F.col(name), F.lit(len(sizes))).cast("int")
    rows = rows.withColumns({
        "__turn": turn, "__start": turn + F.get(F.array(*[F.lit(e) for e in [0, *ends[:-1]]]), place),
        "__stop": turn + F.get(F.array(*[F.lit(e) for e in ends]), place)})
    rows = Runs(index, rows, runs.carried).kept(F.col("__turn"))
    begin = (F.greatest("__start", "__first") - F.col("__first")).cast("int")
    count = (F.least(F.col("__stop"), last + 1) - F.greatest("__start", "__first")).cast("int")
    rows = rows.withColumns({"__begin": begin, "__count": count})
    parts = [F.slice(F.col(f"`{c}`"), F.col("__begin") + 1, F.col("__count")).alias(c) for c in columns]
    pieces = F.sort_array(F.collect_list(F.struct(F.col("__first").alias("__at"), *parts)))
    out = rows.groupBy(BUCKET, name).agg(pieces.alias("__items"), F.sum("__count").cast("int").alias("size"))
    if drop_remainder:
        wanted = F.array(*[F.lit(s) for s in sizes])
        out = out.where(F.col("size") == F.get(wanted, place))
    return out.select(name, "size", *[F.flatten(F.col("__items").getField(c)).alias(c) for c in columns])


# -- padding ---------------------------------------------------------------


def _ranks(kind: T.DataType) -> tuple[int, T.DataType]:
    """How many dimensions an array has, and the type of its cells."""
    rank = 0
    while isinstance(kind, T.ArrayType):
        rank, kind = rank + 1, kind.elementType
    return rank, kind


def _default_padding(kind: T.DataType):
    return F.lit("") if isinstance(kind, T.StringType) else F.lit(0).cast(kind)


def _per_column(value, columns: Sequence[str]) -> dict:
    return {c: value.get(c) for c in columns} if isinstance(value, dict) else {c: value for c in columns}


def _pad(rows: Column, widths: Sequence[Column], fill: Column, what: str) -> Column:
    """Pad every array in an array of arrays, of any rank, to ``widths``; longer ones are an error."""
    blank = fill
    for width in reversed(widths[1:]):
        blank = F.array_repeat(blank, width)

    def one(row):
        short = widths[0] - F.size(row)
        inner = _pad(row, widths[1:], fill, what) if len(widths) > 1 else row
        return F.when(short >= 0, F.concat(inner, F.array_repeat(blank, short))).otherwise(
            F.raise_error(F.concat(F.lit(f"{what}: an element is longer than its padded length "), widths[0].cast("string")))
        )

    return F.transform(rows, one)


def _padded(schema, columns, arrays, padded_shapes, padding_values, boundary: Column | None = None):
    """Array columns padded, others as they are; every column ends up rectangular."""
    shapes, values = _per_column(padded_shapes, columns), _per_column(padding_values, columns)
    out = []
    for c, gathered in zip(columns, arrays):
        rank, cell = _ranks(schema[c].dataType)
        if not rank:
            out.append(gathered)
            continue
        fill = _default_padding(cell) if values[c] is None else F.lit(values[c]).cast(cell)
        found = [F.col(f"__width_{c}_{k}") for k in range(rank)]
        if shapes[c] is not None:
            given = [shapes[c]] if isinstance(shapes[c], int) else list(shapes[c])
            if len(given) > rank:
                raise ValueError(f"{c} has {rank} dimensions, not {len(given)}")
            widths = [f if g is None else F.lit(int(g)) for g, f in zip([*given, *[None] * (rank - len(given))], found)]
        else:
            widths = found if boundary is None else [boundary, *found[1:]]
        out.append(_pad(gathered, widths, fill, c).alias(c))
    return out


def _order_key(order_by) -> Column:
    names = as_list(order_by)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)


def _widths(schema, columns):
    """The largest size of each dimension of each array column."""
    out = []
    for c in columns:
        value = F.col(f"`{c}`")
        for k in range(_ranks(schema[c].dataType)[0]):
            inside = value
            for _ in range(k - 1):
                inside = F.flatten(inside)
            size = F.size(value) if k == 0 else F.coalesce(F.array_max(F.transform(inside, F.size)), F.lit(0))
            out.append(F.max(size).alias(f"__width_{c}_{k}"))
    return out


def padded_batch(
    df: DataFrame,
    batch_size: int,
    order_by,
    padded_shapes: int | dict | None = None,
    padding_values=None,
    drop_remainder: bool = False,
    columns: Sequence[str] | None = None,
    name: str = "batch_id",
) -> DataFrame:
    """Batch rows whose arrays differ in length, padding each array column.

    The padded length is ``padded_shapes`` (one number, or one per column, or a list with
    one for each dimension), or the longest array in the batch.  The padding is 0 or ``""`` unless given.  An array
    longer than a given length is an error, never cut.
    """
    columns = list(columns or df.columns)
    ranked = with_ordinal(df, order_by, "__ord", align=batch_size, keep_bucket=True)
    ranked = ranked.withColumn(name, F.expr(f"__ord div {int(batch_size)}"))
    keys = [BUCKET, name] if BUCKET in ranked.columns else [name]
    out, arrays = _gather(ranked, keys, "__ord", columns, _widths(df.schema, columns))
    if drop_remainder:
        out = out.where(F.col("size") == batch_size)
    return out.select(name, "size", *_padded(df.schema, columns, arrays, padded_shapes, padding_values))


def bucket_by_sequence_length(
    df: DataFrame,
    length,
    bucket_boundaries: Sequence[int],
    bucket_batch_sizes: Sequence[int],
    order_by,
    padded_shapes: int | dict | None = None,
    padding_values=None,
    pad_to_bucket_boundary: bool = False,
    no_padding: bool = False,
    drop_remainder: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Batch rows of similar length together, padding within each batch.

    Lengths fall in ``[0, b1), [b1, b2), ..., [bk, inf)``, with one batch size each.
    Batches come out as they fill and short ones at the end, by bucket: the result
    is ordered by ``(remainder, emitted_at, bucket)``, where ``emitted_at`` is the
    order key of a full batch's last row.  A bucket that holds most rows is ranked
    in many tasks like any other.
    """
    if len(bucket_batch_sizes) != len(bucket_boundaries) + 1:
        raise ValueError("one batch size per bucket: one more than there are boundaries")
    require_batch(df, "bucket_by_sequence_length")
    columns = list(columns or df.columns)
    require_new(df, "bucket", "batch")
    edges = [int(b) for b in bucket_boundaries]
    sized = df.withColumn("__length", as_column(df, length))  # evaluated once, compared several times
    bucket = sum((F.when(F.col("__length") >= b, 1).otherwise(0) for b in edges), F.lit(0))
    batch_size = F.get(F.array(*[F.lit(int(s)) for s in bucket_batch_sizes]), F.col("bucket"))
    bucketed = sized.withColumn("bucket", bucket)
    # lengths may be costly: they are found once for ranking, and once more with the rows
    narrow = written(bucketed.select(*[F.col(f"`{c}`") for c in as_list(order_by)], "bucket"), "lengths")
    runs = build_index(narrow, order_by, "bucket", runs=batch_size).in_runs(bucketed, "__in_bucket")
    ranked = runs.kept(F.col("__in_bucket") - F.pmod("__in_bucket", batch_size.cast("bigint")))
    ranked = ranked.withColumn("batch", F.floor(F.col("__in_bucket") / batch_size).cast("bigint"))
    out, arrays = _gather(
        ranked, [BUCKET, "bucket", "batch"], "__in_bucket", columns,
        [F.max_by(_order_key(order_by), "__in_bucket").alias("__last"), *_widths(df.schema, columns)],
    )
    out = out.withColumn("remainder", F.col("size") < batch_size)
    if drop_remainder:
        out = out.where(~F.col("remainder"))
    boundary = None
    if pad_to_bucket_boundary:
        upper = F.get(F.array(*[F.lit(b - 1) for b in edges]), F.col("bucket"))
        boundary = F.when(F.col("bucket") < len(edges), upper).otherwise(
            F.raise_error(F.lit("pad_to_bucket_boundary: an element is beyond the last boundary")).cast("int")
        )
    made = arrays if no_padding else _padded(df.schema, columns, arrays, padded_shapes, padding_values, boundary)
    emitted = F.when(~F.col("remainder"), F.col("__last"))
    return out.select("remainder", emitted.alias("emitted_at"), "bucket", "batch", "size", *made)


def window(
    df: DataFrame,
    size: int,
    order_by,
    shift: int | None = None,
    stride: int = 1,
    drop_remainder: bool = False,
    name: str = "window_id",
) -> DataFrame:
    """Sliding count windows: window ``w`` holds rows ``w*shift + i*stride`` for ``i < size``.

    One row per window and member, with its place ``window_pos``.  Windows begin as
    long as there is a row to begin with; short ones go if ``drop_remainder``.
    """
    require_batch(df, "window")
    shift = size if shift is None else shift
    if min(size, shift, stride) < 1:
        raise ValueError("size, shift and stride must be at least 1")
    require_new(df, name, "window_pos")
    reach = (size - 1) * stride
    if isinstance(order_by, Ordinal):
        ranked, total = with_ordinal(df, order_by, "__ord"), df.count() if drop_remainder else 0
    else:
        index = build_index(df, order_by)
        ranked, total = index.ranked(df, "__ord").drop(BUCKET), index.total
    # place * stride = row (mod shift): the first place follows from an inverse, the others from the period
    common = gcd(stride, shift)
    period = shift // common
    inverse = pow(stride // common, -1, period)
    first = F.pmod(F.pmod(F.expr(f"__ord div {common}"), F.lit(period)) * inverse, F.lit(period)).cast("int")
    last = F.least(F.lit(size - 1), F.expr(f"__ord div {stride}")).cast("int")
    placed = ranked.withColumns({"__first": first, "__last": last}).where(
        (F.pmod("__ord", F.lit(common)) == 0) & (F.col("__first") <= F.col("__last")))
    members = placed.withColumn("window_pos", F.explode(F.sequence("__first", "__last", F.lit(period))))
    members = members.withColumn(name, F.expr(f"(__ord - cast(window_pos as bigint) * {stride}) div {shift}"))
    if drop_remainder:  # a window is full when there is a row at its last place
        members = members.where(F.col(name) * shift + reach < total)
    return members.select(*[F.col(f"`{c}`") for c in df.columns], name, "window_pos")


def group_by_window(
    df: DataFrame,
    key,
    aggregates: dict[str, Column] | None,
    order_by,
    window_size: int | None = None,
    window_size_func: Callable[[Column], Column] | None = None,
    columns: Sequence[str] | None = None,
    key_name: str = "key",
) -> DataFrame:
    """Group rows by key, cut each group into runs of ``window_size``, reduce each run.

    Give exactly one of ``window_size`` and ``window_size_func`` (from the key's Column
    to the size's).  ``aggregates`` are Column aggregates; with None the rows of a run
    become arrays.  ``window`` numbers the runs of a key, and ``size`` is short only in
    the last.  Runs are found by rank, so no task ever holds a whole group.
    """
    if (window_size is None) == (window_size_func is None):
        raise ValueError("give exactly one of window_size and window_size_func")
    columns = list(columns or df.columns)
    if not (isinstance(key, str) and key == key_name):
        require_new(df, key_name)
    require_new(df, "window")
    keyed = df.withColumn(key_name, as_column(df, key))
    size = F.lit(window_size) if window_size is not None else window_size_func(F.col(key_name))
    ranked = with_ordinal(keyed, order_by, "__in_key", partition_by=key_name, align=size, keep_bucket=True)
    ranked = ranked.withColumn("window", F.floor(F.col("__in_key") / size).cast("bigint"))
    groups = [BUCKET, key_name, "window"]
    if aggregates is None:
        out, arrays = _gather(ranked, groups, "__in_key", [c for c in columns if c != key_name])
        return out.select(key_name, "window", "size", *arrays)
    return ranked.groupBy(*groups).agg(
        F.count(F.lit(1)).cast("int").alias("size"), *[c.alias(n) for n, c in aggregates.items()]
    ).drop(BUCKET)
