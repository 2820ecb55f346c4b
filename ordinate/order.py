"""Positions for rows that have none.

A DataFrame is unordered, so every positional operator in this package names
the columns that order it.  Nulls come first; the columns must be unique together, and
operators that meet two rows of one key raise.

``build_index`` reads only the ordering columns and learns, for a fixed number
of key ranges ("buckets"), where each range starts and what came before it.
The bucket of a row is then a pure function of the row's key, so a recomputed
task always puts a row back in the same place: nothing has to be persisted for
the result to be right.  The index holds one entry per bucket, never per row.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

BUCKET = "__bucket"
#: the range that a row's key lies in, where ``BUCKET`` is the one that it was put in
HOME = "__home"

#: how two partial results of a running measure combine
_COMBINE = {
    "sum": lambda a, b: b if a is None else a if b is None else a + b,
    "count": lambda a, b: (a or 0) + (b or 0),
    "min": lambda a, b: b if a is None else a if b is None else min(a, b),
    "max": lambda a, b: b if a is None else a if b is None else max(a, b),
}


class Ordinal(str):
    """Names a column that already holds 0, 1, 2, ... without gaps.

    Pass ``Ordinal("idx")`` as ``order_by`` after ``enumerate_rows`` and the
    next positional operator is plain arithmetic, with no ranking shuffle.
    """


def as_list(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def require_batch(df: DataFrame, op: str) -> None:
    if df.isStreaming:
        raise ValueError(
            f"{op} needs a total order, which a stream does not have; apply it to "
            "each micro-batch inside foreachBatch, or use ordinate.streaming"
        )


def require_new(df: DataFrame, *names: str) -> None:
    """Raise if a column that an operator adds is there already."""
    taken = [n for n in names if n in df.columns]
    if taken:
        raise ValueError(f"there are columns {taken} already: rename them or give another name")


def check_order(df: DataFrame, order_by) -> None:
    """Raise unless the columns are unique together (reads only them)."""
    names = as_list(order_by)
    wrong = df.groupBy(*names).count().where("count > 1").limit(1).collect()
    if wrong:
        raise ValueError(f"{names} do not order the rows: {wrong[0].asDict()}")


def comparable(df: DataFrame, name: str) -> Column:
    """The column in a form whose values travel to the driver and back unchanged."""
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    if isinstance(kind, T.TimestampNTZType):
        # field by field, so that no session time zone takes part
        seconds = F.unix_date(col.cast("date")).cast("bigint") * 86400 + F.hour(col) * 3600 + F.minute(col) * 60
        return seconds * 1000000 + (F.date_part(F.lit("SECOND"), col) * 1000000).cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    if isinstance(kind, T.BooleanType):
        return col.cast("int")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        raise TypeError(f"cannot order by {name}: {kind.simpleString()}")
    return col


def _table(values: Sequence, ddl: str) -> Column:
    """A constant array, one entry per bucket.

    It enters the plan as one piece of JSON text and is folded to a literal, so plans
    stay small for any number of buckets.
    """

    def plain(value):
        return base64.b64encode(value).decode() if isinstance(value, (bytes, bytearray)) else str(value)

    return F.from_json(F.lit(json.dumps(values, default=plain)), f"array<{ddl}>")


@dataclass(frozen=True)
class OrderIndex:
    """What is known about each key range; the lists have one entry per bucket."""

    order_by: tuple[str, ...]
    partition_by: tuple[str, ...]
    key_ddl: tuple[str, ...]
    lower: list[tuple]  # smallest key in the bucket: (group values..., order values...)
    carry: dict[str, list]  # measure -> value accumulated before the bucket; "n" counts rows
    total: int
    partitions: int
    steps: list[int | None] | None = None  # length of runs in each bucket's first group
    head_ends: list[tuple | None] | None = None  # first key after as many rows of the bucket's first group as a run has

    @property
    def _group_width(self) -> int:
        return len(self.partition_by)

    def key(self, df: DataFrame) -> Column:
        """The sort key of a row: a struct, which compares like the sort, nulls first."""
        parts = [comparable(df, c) for c in (*self.partition_by, *self.order_by)]
        return _pack(parts)

    def key_literal(self, values: tuple) -> Column:
        return _pack([F.lit(v).cast(t) for v, t in zip(values, self.key_ddl)])

    def _key_table(self, keys: list[tuple], ddl: Sequence[str]) -> Column:
        fields = ",".join(f"f{i}:{t}" for i, t in enumerate(ddl))
        return _table([{f"f{i}": v for i, v in enumerate(k)} for k in keys], f"struct<{fields}>")

    def lower_keys(self) -> Column:
        """The smallest key of each bucket."""
        return self._key_table(self.lower, self.key_ddl)

    def with_bucket(self, df: DataFrame, key: Column) -> DataFrame:
        """Add the number of lower bounds at or below ``key``: a binary search per row.

        One projection per halving: each refers to the one before more than once, so
        the optimizer keeps them apart and all of them run inside generated code.
        """
        bounds = self.lower[1:]
        if not bounds:
            return df.withColumn(BUCKET, F.lit(0))
        table = self._key_table(bounds, self.key_ddl)
        key_name = "__key"
        out = df.withColumn(key_name, key)
        at = F.lit(0)
        for i in range(len(bounds).bit_length() - 1, -1, -1):
            further = at + (1 << i)
            at = F.when(F.col(key_name) >= F.get(table, further - 1), further).otherwise(at)
            out = out.withColumn(BUCKET, at)
            at = F.col(BUCKET)
        return out.drop(key_name)

    def place(self, df: DataFrame) -> DataFrame:
        """Bring each key range together: the one full shuffle of a ranking."""
        return self.with_bucket(df, self.key(df)).repartitionById(self.partitions, F.col(BUCKET))

    def window(self):
        return Window.partitionBy(BUCKET, *self.partition_by).orderBy(*self.order_by)

    def before(self, df: DataFrame, measure: str, ddl: str) -> Column:
        """Value of ``measure`` over everything ahead of this row's bucket (null: nothing)."""
        values = self.carry[measure]
        if all(v is None for v in values):
            return F.lit(None).cast(ddl)
        found = F.get(_table(values, ddl), F.col(BUCKET))
        if not self.partition_by:
            return found
        # only the first group of a bucket can have begun in an earlier one
        return F.when(self._in_first_group(df, BUCKET), found)

    @property
    def starts(self) -> list[int]:
        """Position of the first row of each bucket (without groups)."""
        return [n or 0 for n in self.carry["n"]]

    def in_runs(self, df: DataFrame, name: str, weight: Column | None = None) -> "Runs":
        """Rows ranked as by :meth:`ranked`, so that each run of positions can be put together in one bucket.

        The index must know its runs' lengths.  A run belongs to the bucket that holds its first position.  Where a
        bucket begins inside a run, its first rows, as many as a run may have, also go to the bucket of that run.  So the
        rows are moved once, and nothing else is read.  With ``weight`` a row takes as many positions as that says, and
        ``name`` is the first of them.
        """
        placed = self.with_bucket(df, self.key(df)).withColumn(HOME, F.col(BUCKET))
        owners = self._owners()
        if any(o is not None for o in owners):
            here = F.get(_table(owners, "int"), F.col(HOME))
            first = here.isNotNull()
            ends = [None if k is None else {f"f{i}": v for i, v in enumerate(k)} for k in self.head_ends]
            if any(e is not None for e in ends):
                end = F.get(_table(ends, "struct<" + ",".join(f"f{i}:{t}" for i, t in enumerate(self.key_ddl)) + ">"), F.col(HOME))
                first = first & (end.isNull() | (self.key(df) < end))
            if self.partition_by:
                first = first & self._in_first_group(placed, HOME)
            both = F.when(first, F.array(F.col(HOME), here)).otherwise(F.array(F.col(HOME)))
            placed = placed.withColumn(BUCKET, F.explode(both))
        placed = placed.repartitionById(self.partitions, F.col(BUCKET))
        if weight is None:
            position, carried = F.row_number().over(self.window()).cast("bigint") - 1, "n"
        else:
            frame = self.window().rowsBetween(Window.unboundedPreceding, -1)
            position, carried = F.coalesce(F.sum(weight).over(frame), F.lit(0)).cast("bigint"), "weight"
        ahead = F.coalesce(self.before(placed, carried, "bigint"), F.lit(0).cast("bigint"))
        return Runs(self, placed.withColumn(name, self.without_ties(placed, position) + ahead), carried)

    def _owners(self) -> list[int | None]:
        """For each bucket that begins inside a run: the bucket that holds the run's first position."""
        carried, out = self.carry["weight" if "weight" in self.carry else "n"], []
        for b, at in enumerate(carried):
            step = self.steps[b]
            if not at or at % step == 0:
                out.append(None)
                continue
            owner = b - 1
            while owner and (carried[owner] or 0) > at - at % step and self._first_group(owner) == self._first_group(b):
                owner -= 1
            out.append(owner)
        return out

    def _first_group(self, bucket: int) -> tuple:
        return self.lower[bucket][:self._group_width]

    def _in_first_group(self, df: DataFrame, bucket: str) -> Column:
        width = self._group_width
        heads = self._key_table([k[:width] for k in self.lower], self.key_ddl[:width])
        return F.get(heads, F.col(bucket)).eqNullSafe(_pack([comparable(df, c) for c in self.partition_by]))

    def cut_at(self, df: DataFrame, positions: Sequence[int]) -> "OrderIndex":
        """The index (without groups) whose buckets begin at the given positions."""
        positions = [p for p in positions if 0 < p < self.total]
        if positions == self.starts[1:]:
            return self
        found = {}
        if positions:
            ranked = self.ranked(df.select(*[F.col(f"`{c}`") for c in self.order_by]), "__at").where(F.col("__at").isin(positions))
            keys = [comparable(df, c).alias(f"f{i}") for i, c in enumerate(self.order_by)]
            found = {r["__at"]: tuple(r)[1:] for r in ranked.select("__at", *keys).collect()}
        return OrderIndex(
            self.order_by, self.partition_by, self.key_ddl, [*self.lower[:1], *[found[p] for p in positions]],
            {"n": [0, *positions]}, self.total, self.partitions,
        )

    def without_ties(self, placed: DataFrame, value: Column) -> Column:
        """The value, or an error on a row whose key its predecessor has, too: equal keys share a bucket."""
        key = _pack([comparable(placed, c) for c in self.order_by])
        tie = F.lag(key).over(self.window()).eqNullSafe(key)
        return F.when(tie, F.raise_error(F.lit(f"{list(self.order_by)} do not order the rows: two have the same key"))).otherwise(value)

    def ranked(self, df: DataFrame, name: str, start: int = 0) -> DataFrame:
        """Rows placed by bucket, with their position in order as ``name``; equal keys raise."""
        placed = self.place(df)
        position = self.without_ties(placed, F.row_number().over(self.window()).cast("bigint") - 1)
        ahead = F.coalesce(self.before(placed, "n", "bigint"), F.lit(0).cast("bigint"))
        return placed.withColumn(name, position + ahead + F.lit(start).cast("bigint"))


@dataclass(frozen=True)
class Runs:
    """Ranked rows of which some stand in two buckets, and which runs of them count in a bucket."""

    index: OrderIndex
    rows: DataFrame
    carried: str

    def kept(self, first: Column) -> DataFrame:
        """The rows without those whose run, beginning at position ``first``, belongs to another bucket."""
        carried = self.index.carry[self.carried]
        if len(carried) < 2:
            return self.rows.drop(HOME)
        own = F.coalesce(first >= self.index.before(self.rows, self.carried, "bigint"), F.lit(True))
        guest = first < F.get(_table([*carried[1:], None], "bigint"), F.col(BUCKET))
        return self.rows.where(F.when(F.col(BUCKET) == F.col(HOME), own).otherwise(guest)).drop(HOME)


def _pack(parts: Sequence[Column]) -> Column:
    return F.struct(*[p.alias(f"f{i}") for i, p in enumerate(parts)])


def build_index(
    df: DataFrame,
    order_by,
    partition_by=(),
    measures: dict[str, tuple[str, Column]] | None = None,
    buckets: int | None = None,
    runs: int | Column | None = None,
) -> OrderIndex:
    """Learn the key ranges of ``df`` in one job over its ordering columns.

    With ``runs``, the length of runs of positions (a column of the group, if it depends on that), each range also
    returns the key that so many of its rows precede; a measure named ``weight`` then counts instead of rows.

    ``measures`` maps a name to ``(kind, column)`` with kind ``sum``, ``min``,
    ``max`` or ``count``; the index then also carries their running totals.
    With ``partition_by`` everything restarts for each group, and a group of any
    size is still cut into ranges by its order.
    """
    require_batch(df, "an ordered operator")
    groups, order = as_list(partition_by), as_list(order_by)
    if not order:
        raise ValueError("order_by is required: rows of a DataFrame have no order of their own")
    measures = dict(measures or {})
    count = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    g = [f"g{i}" for i in range(len(groups))]
    k = [f"k{i}" for i in range(len(order))]
    m = [f"m{i}" for i in range(len(measures))]
    keys = df.select(
        *[comparable(df, c).alias(n) for c, n in zip(groups + order, g + k)],
        *[col.alias(n) for (_, col), n in zip(measures.values(), m)],
        *([] if runs is None else [(runs if isinstance(runs, Column) else F.lit(runs)).cast("bigint").alias("step")]),
    )
    key_ddl = tuple(keys.schema[n].dataType.simpleString() for n in g + k)
    ranged = keys.repartitionByRange(count, *g, *k).withColumn("pid", F.spark_partition_id())
    heads = []
    if runs is not None:
        if "weight" in measures:
            frame = Window.partitionBy("pid").orderBy(*g, *k).rowsBetween(Window.unboundedPreceding, -1)
            ranged = ranged.withColumn("at", F.coalesce(F.sum(m[list(measures).index("weight")]).over(frame), F.lit(0)))
        else:  # the lower bits of such an id number the rows of a sorted partition
            ranged = ranged.sortWithinPartitions(*g, *k).withColumn("id", F.monotonically_increasing_id())
            ranged = ranged.withColumns({"pid": F.shiftright("id", 33).cast("int"), "at": F.col("id").bitwiseAND((1 << 33) - 1)})
        heads = [F.min(F.when(F.col("at") >= F.col("step"), _pack([F.col(c) for c in g + k]))).alias("after"), F.min("step").alias("step")]
    partial = [
        F.count(F.lit(1)).alias("n"),
        (F.min(_pack([F.col(c) for c in k]))).alias("lo"),
        *[getattr(F, kind)(F.col(c)).alias(c) for (kind, _), c in zip(measures.values(), m)],
    ]
    if groups:
        group = F.struct(*g)
        tail = F.struct("n", *m)
        stats = (
            ranged.groupBy("pid", *g).agg(*partial, *heads).groupBy("pid")
            .agg(
                *([] if runs is None else [F.min("after").alias("after"), F.min_by("step", group).alias("step")]),
                F.sum("n").alias("n"),
                F.count(F.lit(1)).alias("groups"),
                F.min_by(F.struct(*g, "lo"), group).alias("head"),
                F.max(group).alias("last"),
                F.max_by(tail, group).alias("tail"),
            )
        )
    else:
        stats = ranged.groupBy("pid").agg(*partial, *heads)
    found = sorted(stats.collect(), key=lambda r: r["pid"])

    kinds = {"n": "count", **{name: kind for name, (kind, _) in measures.items()}}
    slots = {"n": "n", **dict(zip(measures, m))}
    lower, carry = [], {name: [] for name in kinds}
    previous = None
    for row in found:
        low = tuple(row["lo"]) if not groups else tuple(row["head"][n] for n in g) + tuple(row["head"]["lo"])
        for name, kind in kinds.items():
            if previous is None:
                value = None
            elif not groups:
                value = _COMBINE[kind](carry[name][-1], previous[slots[name]])
            elif tuple(previous["last"]) == low[: len(g)]:
                earlier = carry[name][-1] if previous["groups"] == 1 else None
                value = _COMBINE[kind](earlier, previous["tail"][slots[name]])
            else:
                value = None
            carry[name].append(value)
        lower.append(low)
        previous = row
    total = sum(row["n"] for row in found)
    if runs is None:
        return OrderIndex(tuple(order), tuple(groups), key_ddl, lower, carry, total, count)
    # a key of another group follows all rows of the first one
    ends = [None if r["after"] is None or tuple(r["after"])[:len(g)] != low[:len(g)] else tuple(r["after"]) for r, low in zip(found, lower)]
    return OrderIndex(tuple(order), tuple(groups), key_ddl, lower, carry, total, count, [r["step"] for r in found], ends)


def with_ordinal(
    df: DataFrame,
    order_by,
    name: str = "ord",
    partition_by=(),
    start: int = 0,
    align: int | Column | None = None,
    buckets: int | None = None,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add the 0-based position of each row (within its group, if grouped) as ``name``.

    With ``align`` and ``keep_bucket``, each run of ``align`` positions is in one
    ``BUCKET``: group by that column too, and the rows need not move again.
    """
    if isinstance(order_by, Ordinal) and not as_list(partition_by):
        require_batch(df, "an ordered operator")
        return df.withColumn(name, (F.col(order_by) + start).cast("bigint"))
    index = build_index(df, order_by, partition_by, buckets=buckets, runs=align)
    if align is None:
        out = index.ranked(df, name, start)
    else:
        runs = index.in_runs(df, "__at")
        step = (align if isinstance(align, Column) else F.lit(align)).cast("bigint")
        out = runs.kept(F.col("__at") - F.pmod(F.col("__at"), step)).withColumn(name, F.col("__at") + start).drop("__at")
    return out if keep_bucket else out.drop(BUCKET)


def running(
    df: DataFrame,
    order_by,
    measures: dict[str, tuple[str, Column]],
    partition_by=(),
    exclusive: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Running ``sum``, ``min``, ``max`` or ``count`` in order, one column per measure.

    ``exclusive`` leaves the row itself out.  Nulls are skipped; before the first
    value a sum, min or max is null and a count is 0.
    """
    index = build_index(df, order_by, partition_by, measures, buckets)
    placed = index.place(df)
    frame = index.window().rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    added = {}
    for name, (kind, col) in measures.items():
        here = index.without_ties(placed, getattr(F, kind)(col).over(frame))
        ddl = placed.select(getattr(F, kind)(col).alias("v")).schema["v"].dataType.simpleString()
        ahead = index.before(placed, name, ddl)
        if kind in ("sum", "count"):
            both = F.coalesce(ahead + here, ahead, here)
        else:
            both = (F.least if kind == "min" else F.greatest)(ahead, here)
        if kind == "count":
            both = F.coalesce(both, F.lit(0).cast("bigint"))
        added[name] = both
    return placed.withColumns(added).drop(BUCKET)


#: a range of keys that is sorted at once, and ranges of one step
SORTED_KEYS, STEP_RANGES = 1 << 18, 16


def key_at(df: DataFrame, order_by, position: int) -> tuple[OrderIndex, tuple | None]:
    """The sort key of the row at ``position`` (from 0), or None if there are fewer rows.

    Comes with an index that can compare keys with it.  The range of keys that holds the
    position is divided again until it is short; every step reads that range's keys only.
    A key that stands twice at the position raises.
    """
    names = as_list(order_by)
    cols = [f"f{i}" for i in range(len(names))]
    keys = df.select(*[comparable(df, c).alias(n) for c, n in zip(names, cols)])
    ranges = max(STEP_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    whole, inside, index = None, keys, build_index(df, names, buckets=ranges)
    while True:
        whole = whole or index
        if position >= index.total:
            return whole, None
        at = max(b for b, start in enumerate(index.starts) if start <= position)
        upper = index.lower[at + 1] if at + 1 < len(index.lower) else None
        size = (index.starts[at + 1] if upper else index.total) - index.starts[at]
        if at:
            inside = inside.where(_after(inside, cols, index, index.lower[at]))
        if upper:
            inside = inside.where(_ahead(inside, cols, index, upper))
        position -= index.starts[at]
        if size <= SORTED_KEYS:
            break
        if size == index.total:
            raise ValueError(f"{names} do not order the rows: {size} keys cannot be told apart")
        index = build_index(inside, cols, buckets=ranges)
    first = max(0, position - 1)
    near = [tuple(r) for r in inside.orderBy(*cols).offset(first).limit(position - first + 2).collect()]
    found = near[position - first]
    if near.count(found) > 1:
        raise ValueError(f"{names} do not order the rows: {found} stands twice")
    return whole, found


def _after(df: DataFrame, names: Sequence[str], index: OrderIndex, bound: tuple) -> Column:
    """Rows at or after ``bound``; the plain first-column test is what Parquet can prune on."""
    whole = _pack([comparable(df, n) for n in names]) >= index.key_literal(bound)
    if bound[0] is None:
        return whole
    return whole & (comparable(df, names[0]) >= F.lit(bound[0]).cast(index.key_ddl[0]))


def _ahead(df: DataFrame, names: Sequence[str], index: OrderIndex, bound: tuple) -> Column:
    """Rows strictly before ``bound``."""
    first = comparable(df, names[0])
    whole = _pack([comparable(df, n) for n in names]) < index.key_literal(bound)
    if bound[0] is None:
        return whole & first.isNull()
    return whole & (first.isNull() | (first <= F.lit(bound[0]).cast(index.key_ddl[0])))


def from_key(df: DataFrame, index: OrderIndex, bound: tuple) -> Column:
    """Rows at or after ``bound``."""
    return _after(df, index.order_by, index, bound)


def before_key(df: DataFrame, index: OrderIndex, bound: tuple) -> Column:
    """Rows strictly before ``bound``."""
    return _ahead(df, index.order_by, index, bound)


def key_types(df: DataFrame, order_by) -> tuple[str, ...]:
    return tuple(df.select(comparable(df, c).alias("v")).schema["v"].dataType.simpleString() for c in as_list(order_by))
