"""Folds, scans, distinct rows, resampling and the size and shape of a dataset."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ordinate.functions.hashing import uniform
from ordinate.operators.mapping import as_column
from ordinate.order import BUCKET, as_list, build_index, comparable, require_batch, require_new, running
from ordinate.scratch import written

#: the state that a range starts from, beside its first row
START = "__start"


#: how a starting value joins an aggregate
_START = {"sum": lambda a, b: F.coalesce(a + b, a), "min": F.least, "max": F.greatest}


def reduce_rows(df: DataFrame, aggregates: dict[str, Column], initial: dict[str, tuple[str, object]] | None = None) -> DataFrame:
    """Reduce to one row with Column aggregates (partial sums first, then one merge).

    ``initial`` gives aggregates a value to start from, used once: its name, and ``sum``, ``min`` or ``max`` with the value.
    """
    started = dict(aggregates)
    for name, (kind, value) in (initial or {}).items():
        started[name] = _START[kind](F.lit(value), aggregates[name])
    return df.agg(*[c.alias(n) for n, c in started.items()])


def _in_order(df: DataFrame, order_by):
    """Rows brought together by key range and sorted, ranges numbered in ``BUCKET``."""
    names = as_list(order_by)
    index = build_index(df, names)
    placed = index.place(df)
    placed = placed.withColumn(BUCKET, index.without_ties(placed, F.col(BUCKET))).sortWithinPartitions(BUCKET, *names)
    return index, placed


def _by_range(frames):
    """Split a stream of pandas frames where the key range changes."""
    for frame in frames:
        if len(frame):
            cuts = (frame[BUCKET] != frame[BUCKET].shift()).cumsum()
            for _, part in frame.groupby(cuts, sort=False):
                yield int(part[BUCKET].iloc[0]), part.drop(columns=BUCKET).reset_index(drop=True)


#: states that are merged at a time
TOGETHER = 4
STATES = "bucket int, state binary"


def _same(a, b) -> bool:
    """Whether two states of any kind are equal, arrays among them."""
    if pickle.dumps(a) == pickle.dumps(b):
        return True
    try:
        return bool(np.all(np.equal(a, b))) if isinstance(a, np.ndarray) else bool(a == b)
    except ValueError:
        return False


def _range_states(placed: DataFrame, initial, zero, step: Callable, merge: Callable) -> DataFrame:
    """Fold every key range on its own, in parallel, to a table of one state for each range.

    Without ``zero`` ranges start from ``initial``, which each state that it is merged with must leave as it was.
    """
    unlike = "initial changes what it is merged with: give zero, a state that does not, for the ranges to start from"
    if zero is None and not _same(merge(initial, initial), initial):
        raise ValueError(unlike)

    def ended(at: int, state) -> pd.DataFrame:
        if zero is None and not (_same(merge(initial, state), state) and _same(merge(state, initial), state)):
            raise ValueError(unlike)
        return pd.DataFrame({"bucket": [at], "state": [pickle.dumps(state)]})

    def fold(frames):
        at, state = None, None
        for bucket, part in _by_range(frames):
            if bucket != at:
                if at is not None:
                    yield ended(at, state)
                at, state = bucket, initial if zero is None else zero
            state = step(state, part)
        if at is not None:
            yield ended(at, state)

    return written(placed.mapInPandas(fold, STATES), "states")


def _merged(states: DataFrame, ranges: int, merge: Callable) -> list[DataFrame]:
    """The states of ranges, of every few neighbouring ranges, of as many of those, and so on up to all: a table each."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bucket")
        state = reduce(merge, map(pickle.loads, frame["state"]))
        return pd.DataFrame({"bucket": [int(frame["bucket"].iloc[0]) // TOGETHER], "state": [pickle.dumps(state)]})

    levels = [states]
    while ranges > 1:
        levels.append(written(levels[-1].groupBy(F.expr(f"bucket div {TOGETHER}")).applyInPandas(join, STATES), "states"))
        ranges = -(-ranges // TOGETHER)
    return levels


def _starts(levels: list[DataFrame], initial, merge: Callable) -> DataFrame:
    """The state that each range starts from: that of the few ranges around it, merged with its neighbours' before it."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bucket")
        first = frame["start"].iloc[0]
        state, out = initial if first is None else pickle.loads(first), []
        for own in frame["state"]:
            out.append(pickle.dumps(state))
            state = merge(state, pickle.loads(own))
        return pd.DataFrame({"bucket": frame["bucket"], "state": out})

    starts = None
    for level in reversed(levels):
        here = level.withColumn("above", F.expr(f"bucket div {TOGETHER}"))
        if starts is None:
            here = here.withColumn("start", F.lit(None).cast("binary"))
        else:
            here = here.join(starts.select(F.col("bucket").alias("above"), F.col("state").alias("start")), "above")
        starts = written(here.groupBy("above").applyInPandas(run, STATES), "starts")
    return starts


def fold_rows(df: DataFrame, order_by, initial, step: Callable, merge: Callable, finish: Callable | None = None, zero=None):
    """Fold the rows in order with Python functions and return the final state.

    ``step(state, frame)`` takes in a pandas frame of consecutive rows and
    ``merge(earlier, later)`` joins the states of neighbouring key ranges, so the
    rows are folded in parallel.  States of any size are merged a few at a time by tasks, in
    rounds, and the driver gets the last one only.
    A fold that cannot be merged has no parallel form and is not accepted.

    ``initial`` is used once, before the first row.  Ranges start from ``zero``, a state that
    changes nothing when merged; it may be left out if ``initial`` is one, which is checked against
    the state of every range.
    """
    if merge is None:
        raise ValueError("a fold needs merge(earlier, later) to run on more than one task")
    index, placed = _in_order(df, order_by)
    if index.total:
        states = _range_states(placed, initial, zero, step, merge)
        last = _merged(states, len(index.lower), merge)[-1].first()
        total = merge(initial, pickle.loads(bytes(last["state"])))
    else:
        total = initial
    return finish(total) if finish else total


def scan(
    df: DataFrame,
    order_by,
    measures: dict[str, tuple[str, Column]],
    partition_by=(),
    exclusive: bool = False,
) -> DataFrame:
    """Running ``sum``, ``min``, ``max`` or ``count`` in order, within groups if any."""
    return running(df, order_by, measures, partition_by, exclusive)


def scan_rows(
    df: DataFrame, order_by, initial, step: Callable, merge: Callable, emit: Callable, schema, zero=None
) -> DataFrame:
    """Stateful map over the rows in order with Python functions.

    First every key range is folded (``step``, as in :func:`fold_rows`) to learn the
    state it ends with; merging those, by tasks in rounds, gives the state each range starts from, which
    comes with the range's first row.  Then ``emit(state, frame) -> (state, out)`` runs over each range from its own start.
    """
    require_new(df, START)
    index, placed = _in_order(df, order_by)
    if not index.total:
        return df.sparkSession.createDataFrame([], schema)
    states = _range_states(placed, initial, zero, step, merge)
    starts = _starts(_merged(states, len(index.lower), merge), initial, merge)
    starts = starts.select(F.col("bucket").alias(BUCKET), F.col("state").alias(START))
    rows = index.with_bucket(df, index.key(df))
    first = index.key(df).eqNullSafe(F.get(index.lower_keys(), F.col(BUCKET)))
    heads = rows.where(first).join(starts, BUCKET, "left")
    rows = heads.unionByName(rows.where(~first).withColumn(START, F.lit(None).cast("binary"))).select(*df.columns, BUCKET, START)
    placed = rows.repartitionById(index.partitions, F.col(BUCKET))
    placed = placed.withColumn(BUCKET, index.without_ties(placed, F.col(BUCKET))).sortWithinPartitions(BUCKET, *as_list(order_by))

    def run(frames):
        state = None
        for _, part in _by_range(frames):
            if part[START].iloc[0] is not None:
                state = pickle.loads(part[START].iloc[0])
            state, out = emit(state, part.drop(columns=START))
            yield out

    return placed.mapInPandas(run, schema)


def unique(df: DataFrame, columns: Sequence[str] | None = None, order_by=None) -> DataFrame:
    """Distinct rows, or one row per distinct ``columns``.

    With ``order_by`` it is the first in order that stays: the smallest key of each value, found by
    an aggregate with partial results before the shuffle, chooses the rows.  Two rows of a value that share that key raise.
    """
    if columns is None and order_by is None:
        return df.dropDuplicates()
    columns = list(columns or [c for c in df.columns if c not in as_list(order_by)])
    if order_by is None:
        return df.dropDuplicates(columns)
    require_batch(df, "unique with order_by")
    keys = {f"__k{i}": comparable(df, c) for i, c in enumerate(as_list(order_by))}
    groups = {f"__g{i}": F.col(f"`{c}`") for i, c in enumerate(columns)}
    narrow = df.select(*[c.alias(n) for n, c in groups.items()], F.struct(*[c.alias(n) for n, c in keys.items()]).alias("__key"),
                       F.monotonically_increasing_id().alias("__row"))
    # of rows that share the smallest key one has the smallest number and another the largest
    ends = [F.min(F.struct("__key", row.alias("row"))).alias(name) for name, row in (("__low", F.col("__row")), ("__high", -F.col("__row")))]
    first = narrow.groupBy(*groups).agg(*ends)
    one = F.col("__low.row") == -F.col("__high.row")
    tie = F.raise_error(F.lit(f"{as_list(order_by)} do not order the rows: two rows of one value have the same key"))
    first = first.select(*groups, F.when(one, F.col("__low").getField("__key")).otherwise(tie).alias("__key")).select(*groups, "__key.*")
    same = F.lit(True)
    for name, c in {**groups, **keys}.items():
        same = same & c.eqNullSafe(F.col(name))
    return df.join(first, same, "left_semi")


def rejection_resample(
    df: DataFrame,
    class_of,
    target_dist: Sequence[float],
    seed: int,
    order_by,
    initial_dist: Sequence[float] | None = None,
    name: str = "class_id",
) -> DataFrame:
    """Drop rows at random so that classes ``0..k-1`` occur in ``target_dist``'s ratio.

    A row of class ``c`` stays with probability ``t_c/i_c`` over the largest such
    ratio.  ``initial_dist`` is counted from the data if not given.  Whether a row
    stays depends on the seed and its order key only.
    """
    require_batch(df, "rejection_resample")
    require_new(df, name)
    for dist in (target_dist, initial_dist):
        if dist is not None and (len(dist) != len(target_dist) or min(dist) < 0 or abs(sum(dist) - 1) > 1e-6):
            raise ValueError("distributions need one share per class, not negative, that add up to 1")
    classed = df.withColumn(name, as_column(df, class_of).cast("int"))
    k = len(target_dist)
    if initial_dist is None:
        inside = F.col(name).between(0, k - 1)
        counts = {r[name]: r["count"] for r in classed.where(inside).groupBy(name).count().collect()}
        total = sum(counts.values())
        initial_dist = [counts.get(c, 0) / total if total else 0.0 for c in range(k)]
    ratios = []
    for c, (t, i) in enumerate(zip(target_dist, initial_dist)):
        if t > 0 and i <= 0:
            raise ValueError(f"class {c} is wanted but does not occur")
        ratios.append(t / i if t > 0 else 0.0)
    keep = [r / max(ratios) for r in ratios]
    chance = F.get(F.array(*[F.lit(float(p)) for p in keep]), F.col(name))
    inside = F.coalesce(F.col(name).between(0, k - 1), F.lit(False))
    outside = F.when(~inside, F.raise_error(F.lit(f"class outside [0, {k})")).cast("double"))
    key = [comparable(df, c) for c in as_list(order_by)]
    return classed.where(uniform(seed, *key) < F.coalesce(outside, chance))


def length(df: DataFrame) -> float:
    """Number of rows; infinite for a stream."""
    return float("inf") if df.isStreaming else df.count()


def output_types(df: DataFrame) -> dict[str, str]:
    """Spark type names of the columns, from the schema alone."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def output_shapes(df: DataFrame) -> DataFrame:
    """One row per column: its ``rank`` and, for arrays, smallest and largest length."""
    ranks, aggs = [], []
    for f in df.schema.fields:
        rank, kind = 0, f.dataType
        while isinstance(kind, T.ArrayType):
            rank, kind = rank + 1, kind.elementType
        ranks.append((f.name, rank))
        if rank:
            aggs += [F.min(F.size(f"`{f.name}`")).alias(f"{f.name}__lo"), F.max(F.size(f"`{f.name}`")).alias(f"{f.name}__hi")]
    none = F.lit(None).cast("int")
    rows = [
        F.struct(
            F.lit(n).alias("column"), F.lit(r).alias("rank"),
            (F.col(f"`{n}__lo`") if r else none).alias("min_length"),
            (F.col(f"`{n}__hi`") if r else none).alias("max_length"),
        )
        for n, r in ranks
    ]
    found = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("__n"))
    return found.select(F.inline(F.array(*rows)))
