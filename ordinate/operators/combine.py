"""Merging several sequences, and changing the order of one.

These operators do not sort.  They add columns that define the new order; give
those to the next operator as its ``order_by`` (or to ``DataFrame.orderBy``).
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ordinate.functions.hashing import seeded_hash, uniform
from ordinate.operators.mapping import as_column
from ordinate.operators.position import concatenate, repeat
from ordinate.order import Ordinal, as_list, comparable, require_batch, require_new, running, with_ordinal
from ordinate.scratch import written

#: arrival times are whole numbers of this fraction, so that sums are exact
ARRIVAL_SCALE = 1_000_000

#: sources of which the turns can be found, if not all are open at a time: one task walks over them
MOST_SOURCES = 10_000_000


def _keys(df: DataFrame, order_by) -> list[Column]:
    return [comparable(df, c) for c in as_list(order_by)]


def shuffle(
    df: DataFrame, order_by, seed: int, buffer_size: int | None = None, epoch=None, name: str = "shuffle_key"
) -> DataFrame:
    """Give the rows a random order: sort by ``name``, then by ``order_by``.

    The order depends on the seed (and ``epoch``, a number or column) and each row's
    key only.  With ``buffer_size`` rows move only within consecutive blocks of that
    many; sort by ``name + "_block"`` first.
    """
    require_batch(df, "shuffle")
    require_new(df, name)
    parts = _keys(df, order_by)
    if epoch is not None:
        parts = [as_column(df, epoch) if isinstance(epoch, (str, Column)) else F.lit(epoch), *parts]
    mixed = df.withColumn(name, seeded_hash(seed, *parts))
    if buffer_size is None:
        return mixed
    ranked = with_ordinal(mixed, order_by, "__ord")
    return ranked.withColumn(f"{name}_block", F.expr(f"__ord div {int(buffer_size)}")).drop("__ord")


def shuffle_and_repeat(
    df: DataFrame, order_by, count: int, seed: int, buffer_size: int | None = None, name: str = "shuffle_key"
) -> DataFrame:
    """``count`` epochs, each in its own random order: sort by ``epoch`` and then as in :func:`shuffle`."""
    require_batch(df, "shuffle_and_repeat")
    if buffer_size is not None:  # blocks are the same in every epoch: rank once, before copying
        ranked = with_ordinal(df, order_by, "__ord")
        df = ranked.withColumn(f"{name}_block", F.expr(f"__ord div {int(buffer_size)}")).drop("__ord")
    return shuffle(repeat(df, count), order_by, seed, epoch="epoch", name=name)


def interleave(
    df: DataFrame, source, order_by, source_order=None, cycle_length: int = 1, block_length: int = 1, sources: Sequence | None = None
) -> DataFrame:
    """Take rows from several sources in turn.

    ``cycle_length`` sources are open at a time; each turn takes ``block_length``
    rows from one.  When a source runs out, the next unopened one takes its place in
    the following round.  Sources open in order of ``source`` (or of the aggregate
    ``source_order`` over their rows), or as listed in ``sources``, which may name empty
    ones: an empty source takes up its turn.  If not all sources are open at a time, there
    may be ``MOST_SOURCES`` of them at most.

    The result is ordered by ``(round, slot, block_pos)``.  A row's round is its
    source's first round plus its rank in the source over ``block_length``, so the
    schedule needs one row per *source*, from the sources' row counts.
    """
    if cycle_length < 1 or block_length < 1:
        raise ValueError("cycle_length and block_length must be at least 1")
    require_batch(df, "interleave")
    require_new(df, "round", "slot", "block_pos")
    keyed = df.withColumn("__source", as_column(df, source))
    rank = F.col("__source") if source_order is None else source_order
    counts = keyed.groupBy("__source").agg(F.count(F.lit(1)).alias("rows"), F.min(rank).alias("rank"))
    if sources is not None:
        kind = keyed.schema["__source"].dataType.simpleString()
        given = df.sparkSession.createDataFrame([(s, i) for i, s in enumerate(dict.fromkeys(sources))], f"__given {kind}, rank bigint")
        held = counts.select("__source", "rows")
        counts = given.join(held, F.col("__given").eqNullSafe(F.col("__source")), "left").select(
            F.col("__given").alias("__source"), F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), "rank")
    # a source is found to be empty only on the turn after its last full block
    turns = written(counts.withColumn("turns", F.expr(f"rows div {int(block_length)}") + 1), "interleave")
    number = turns.count()
    if number <= cycle_length:  # all are open from the start
        places = with_ordinal(turns, ["rank", "__source"], "slot")
        plan = places.select(F.col("__source").alias("__opened"), F.lit(0).cast("bigint").alias("first_round"), F.col("slot").cast("int").alias("slot"))
    elif number <= MOST_SOURCES:
        plan = written(_open_sources(turns, cycle_length), "interleave")
    else:
        raise ValueError(f"{number} sources, {cycle_length} open at a time: at most {MOST_SOURCES} can be planned")
    ranked = with_ordinal(keyed, order_by, "__k", partition_by="__source")
    out = ranked.join(plan, F.col("__source").eqNullSafe(F.col("__opened")))
    return out.select(
        (F.col("first_round") + F.expr(f"__k div {int(block_length)}")).alias("round"),
        "slot",
        (F.col("__k") % int(block_length)).cast("int").alias("block_pos"),
        *[F.col(f"`{c}`") for c in df.columns],
    )


def _open_sources(turns: DataFrame, cycle_length: int) -> DataFrame:
    """First round and slot of each source.

    Which slot frees up next depends on all sources before, so this walks the
    sources once in order - one small row per source, streamed, with a heap of
    ``cycle_length`` slots as the only state.
    """
    kind = turns.schema["__source"].dataType.simpleString()

    def walk(frames):
        free = [(0, slot) for slot in range(cycle_length)]
        for frame in frames:
            first, slots = [], []
            for needed in frame["turns"]:
                at, slot = free[0]
                heapq.heapreplace(free, (at + int(needed), slot))
                first.append(at)
                slots.append(slot)
            yield pd.DataFrame({"__opened": frame["__source"], "first_round": first, "slot": slots})

    ordered = turns.repartition(1).sortWithinPartitions("rank", "__source").select("__source", "turns")
    return ordered.mapInPandas(walk, f"__opened {kind}, first_round bigint, slot int")


def choose_from_datasets(
    inputs: Sequence[tuple[DataFrame, object]],
    choices: DataFrame,
    choice: str,
    choice_order,
    stop_on_empty: bool = True,
    name: str = "step",
) -> DataFrame:
    """Element ``i`` is the next unread row of the input named by choice ``i``.

    When the chosen input has run out, the result ends there, or with
    ``stop_on_empty=False`` that choice is passed over.  Ordered by ``name``, the
    position of the choice.
    """
    n = len(inputs)
    tagged = [df.withColumns({f"__o{j}": c for j, c in enumerate(_keys(df, order))}) for df, order in inputs]
    pool = concatenate(*tagged)
    keys = [f"__o{j}" for j in range(len(as_list(inputs[0][1])))]
    counted = {i: df.count() for i, (df, _) in enumerate(inputs)} if stop_on_empty else {}
    pool = with_ordinal(pool, keys, "__k", partition_by="source_id").drop(*keys)
    columns = [c for c in pool.columns if c not in ("source_id", "__k")]

    chosen = F.col(choice).cast("int")
    known = F.when(chosen.between(0, n - 1), chosen).otherwise(F.raise_error(F.lit(f"a choice is outside [0, {n})")).cast("int"))
    steps = choices.withColumn("source_id", known)
    if isinstance(choice_order, Ordinal):
        steps = steps.withColumn("__at", F.col(choice_order).cast("bigint"))
        choice_order = "__at"
    # one pass over the choices ranks them overall and within each input
    picked = {f"__n{i}": ("count", F.when(F.col("source_id") == i, 1)) for i in range(n)}
    steps = running(steps, choice_order, {"__n": ("count", F.lit(1)), **picked})
    mine = F.coalesce(*[F.when(F.col("source_id") == i, F.col(f"__n{i}")) for i in range(n)])
    picks = steps.select((F.col("__n") - 1).alias(name), "source_id", (mine - 1).alias("__k"))
    if stop_on_empty:
        # the k-th pick of an input fails when k reaches the input's row count
        rows = F.get(F.array(*[F.lit(counted.get(i, 0)).cast("bigint") for i in range(n)]), F.col("source_id"))
        stop = picks.where(F.col("__k") >= rows).agg(F.min(name).alias("v")).scalar()
        picks = picks.where(F.coalesce(F.col(name) < stop, F.lit(True)))
    joined = picks.join(pool, ["source_id", "__k"])
    return joined.select(name, "source_id", *[F.col(f"`{c}`") for c in columns])


def sample_from_datasets(
    inputs: Sequence[tuple[DataFrame, object]],
    seed: int,
    weights: Sequence[float] | DataFrame | None = None,
    stop_on_empty: bool = True,
    weights_order=None,
    weights_column: str = "weights",
) -> DataFrame:
    """Interleave the inputs at random, each drawn in proportion to its weight.

    Every row waits an exponential time after the one before it in its input, at the
    input's weight as rate; rows come out in order of arrival.  Exponential times
    have no memory, so the next row is always a fresh weighted draw, also among the
    inputs left once another has run out.  With ``stop_on_empty`` the result ends
    where an exhausted input would have been drawn again.

    ``weights`` may also be a DataFrame with one array of weights per step (ordered by
    ``weights_order``); there are then at most as many steps as it has rows.
    The result is ordered by ``(arrival, source_id, source_pos)``, or by ``step`` if
    the weights vary.
    """
    n = len(inputs)
    if isinstance(weights, DataFrame):
        steps = with_ordinal(weights, weights_order, "__step")
        shares = F.col(weights_column)
        total = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
        point = uniform(seed, F.col("__step")) * total
        upto = [F.aggregate(F.slice(shares, 1, i + 1), F.lit(0.0), lambda a, b: a + b) for i in range(n - 1)]
        drawn = sum((F.when(point >= u, 1).otherwise(0) for u in upto), F.lit(0))
        picks = steps.select("__step", drawn.alias("choice"))
        return choose_from_datasets(inputs, picks, "choice", Ordinal("__step"), stop_on_empty)

    rates = [1.0] * n if weights is None else [float(w) for w in weights]
    if len(rates) != n or min(rates) < 0 or max(rates) == 0:
        raise ValueError("one non-negative weight per input, not all zero")
    total = sum(rates)
    rates = [r / total for r in rates]  # only their ratios count
    live = [i for i in range(n) if rates[i] > 0]
    tagged = []
    for i in live:
        df, order = inputs[i]
        keys = {f"__o{j}": c for j, c in enumerate(_keys(df, order))}
        wait = _wait(seed, rates[i], F.lit(i), *keys.values())
        tagged.append(df.withColumns({**keys, "__wait": wait, "source_id": F.lit(i)}))
    pool = concatenate(*tagged, name="__nth").drop("__nth")
    keys = [f"__o{j}" for j in range(len(as_list(inputs[0][1])))]
    timed = running(
        pool, keys, {"arrival": ("sum", F.col("__wait")), "__n": ("count", F.col("__wait"))}, partition_by="source_id"
    )
    columns = [c for c in pool.columns if c not in (*keys, "__wait", "source_id")]
    if stop_on_empty:
        # each input's first missing row arrives one more wait after its last row
        ends = [
            pool.where(F.col("source_id") == i).agg(
                (F.coalesce(F.sum("__wait"), F.lit(0)) + _wait(seed, rates[i], F.lit(i), F.lit("end"))).alias("v")
            ).scalar()
            for i in live
        ]
        timed = timed.where(F.col("arrival") < (F.least(*ends) if len(ends) > 1 else ends[0]))
    return timed.select(
        "arrival", "source_id", (F.col("__n") - 1).alias("source_pos"), *[F.col(f"`{c}`") for c in columns]
    )


def _wait(seed: int, rate: float, *parts: Column) -> Column:
    # 1 - u lies in (0, 1], so the logarithm is finite
    return F.floor(-F.log(F.lit(1.0) - uniform(seed, *parts)) / F.lit(rate) * F.lit(float(ARRIVAL_SCALE))).cast("bigint")
