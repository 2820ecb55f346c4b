"""Per-key state on streams: scans and count windows.

The sequence of a key is its rows in order of arrival; rows that arrive in one
micro-batch are put in order of ``order_by``.  A key's state is kept between
batches by Spark and survives restarts with the query's checkpoint.  What a task
holds of a key is one micro-batch, so bound that at the source (for files with
``maxFilesPerTrigger``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ordinate.order import as_list


def _arrived(frames, order: list[str]) -> pd.DataFrame:
    return pd.concat(list(frames)).sort_values(order, ignore_index=True)


def scan_stream(df: DataFrame, key, order_by, initial, emit: Callable, schema: str) -> DataFrame:
    """Stateful map per key: ``emit(state, frame) -> (state, out)`` for each batch of a key's rows."""
    order = as_list(order_by)

    def step(_, frames, state):
        held = pickle.loads(state.get[0]) if state.exists else initial
        held, out = emit(held, _arrived(frames, order))
        state.update((pickle.dumps(held),))
        yield out

    return df.groupBy(*as_list(key)).applyInPandasWithState(
        step, schema, "held binary", "append", GroupStateTimeout.NoTimeout)


def short_windows(spark: SparkSession, checkpoint: str, reduce: Callable, schema: str) -> DataFrame:
    """The last windows of all keys of an ended :func:`group_by_window_stream`, from the state in its checkpoint.

    Each key's waiting rows, fewer than a window, are reduced as a window of their own.
    """
    held = spark.read.format("statestore").load(checkpoint).select("key", "value")
    held = held.select(F.struct("key.*").alias("key"), F.col("value.groupState.held").alias("held"))

    def finish(frames):
        for frame in frames:
            for key, state in zip(frame["key"], frame["held"]):
                number, rest = pickle.loads(bytes(state))
                if rest is not None and len(rest):
                    yield reduce(tuple(key.values()) if isinstance(key, dict) else tuple(key), number, rest)

    return held.mapInPandas(finish, schema)


def group_by_window_stream(
    df: DataFrame, key, order_by, window_size: int | Callable[[tuple], int], reduce: Callable, schema: str,
    flush_after_ms: int | None = None,
) -> DataFrame:
    """Every ``window_size`` rows of a key, reduced by ``reduce(key, number, frame) -> frame``.

    ``window_size`` may be a function of the key.  Rows wait in state until their window
    is full.  With ``flush_after_ms`` a key that stays quiet that long gives out its
    short window; otherwise the last rows wait for more, and :func:`short_windows` gives them when
    the stream has ended.
    """
    order = as_list(order_by)
    waiting = GroupStateTimeout.ProcessingTimeTimeout if flush_after_ms else GroupStateTimeout.NoTimeout

    def step(group, frames, state):
        number, rest = pickle.loads(state.get[0]) if state.exists else (0, None)
        if state.hasTimedOut:
            if rest is not None and len(rest):
                yield reduce(group, number, rest)
                number += 1
            state.update((pickle.dumps((number, None)),))
            return
        size = window_size(group) if callable(window_size) else window_size
        fresh = _arrived(frames, order)
        rows = fresh if rest is None else pd.concat([rest, fresh], ignore_index=True)
        full = len(rows) // size * size
        for start in range(0, full, size):
            yield reduce(group, number, rows.iloc[start:start + size])
            number += 1
        rest = rows.iloc[full:].reset_index(drop=True)
        state.update((pickle.dumps((number, rest)),))
        if flush_after_ms and len(rest):
            state.setTimeoutDuration(flush_after_ms)

    return df.groupBy(*as_list(key)).applyInPandasWithState(step, schema, "held binary", "append", waiting)
