"""Per-key state on streams, as columns of Spark's state store, with timers in event time.

A key's state is typed values and lists of rows, each read and written by itself, and not one object for
all of it.  Timers give out what still waits once the watermark has passed a key.  State survives restarts with the
query's checkpoint; it needs the store that :func:`column_state` chooses while a query starts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ordinate.order import as_list, require_new

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_DUE = "__event_ms"


@contextmanager
def column_state(spark: SparkSession):
    """Queries that are started inside keep their state in RocksDB; the session's own setting comes back afterwards."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _arrived(rows: Iterator[pd.DataFrame], names: list[str], order: list[str]) -> pd.DataFrame:
    """A key's rows of a micro-batch in their order.

    Spark may hand over frames without rows or columns, and gives columns whose names are no identifiers other ones.
    """
    frames = [frame.set_axis(names, axis=1) for frame in rows if len(frame)]
    if not frames:
        return pd.DataFrame(columns=names)
    return (pd.concat(frames) if len(frames) > 1 else frames[0]).sort_values(order, ignore_index=True)


def _tuples(frame: pd.DataFrame) -> list[tuple]:
    """Rows with nulls as None, which the state store takes."""
    columns = (frame.iloc[:, i] for i in range(frame.shape[1]))
    return list(zip(*([None if null else v for v, null in zip(c.tolist(), c.isna().tolist())] for c in columns)))


def _together(frames: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A key's results as one frame, as each goes to Spark by itself, unless their types differ."""
    if len(frames) > 1 and all(frame.dtypes.equals(frames[0].dtypes) for frame in frames[1:]):
        frames = [pd.concat(frames, ignore_index=True)]
    yield from frames


class _Windows(StatefulProcessor):
    def __init__(self, schema, order: list[str], size, reduce: Callable, gap_ms: int):
        self._schema, self._order, self._size, self._reduce, self._gap = schema, order, size, reduce, gap_ms
        self._names = schema.names
        self._columns = [name for name in self._names if name != _DUE]

    def init(self, handle) -> None:
        self._handle = handle
        self._progress = handle.getValueState("progress", "number bigint, latest bigint")
        places = [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(self._schema.fields)]  # the store takes plain names only
        self._waiting = handle.getListState("waiting", T.StructType(places))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = _arrived(rows, self._names, self._order)
        if not len(fresh):
            return
        now = int(fresh[_DUE].max())
        number, latest = self._progress.get() or (0, None)  # each call asks the store: none more than needed
        waiting = list(self._waiting.get()) if latest is not None else []
        if waiting:
            held = pd.DataFrame(waiting, columns=self._names).astype(fresh.dtypes.to_dict())
            fresh = pd.concat([held, fresh], ignore_index=True)
        size = self._size(key) if callable(self._size) else self._size
        full = len(fresh) // size * size
        columns = fresh[self._columns]
        yield from _together([
            self._reduce(key, number + i, columns.iloc[start:start + size]) for i, start in enumerate(range(0, full, size))])
        number += full // size
        rest = fresh.iloc[full:]
        if waiting and not len(rest):
            self._waiting.clear()
        elif len(rest):
            self._waiting.put(_tuples(rest))
        if latest is not None:
            if waiting:
                self._handle.deleteTimer(latest + self._gap)
            now = max(now, latest)
        if len(rest):
            self._handle.registerTimer(now + self._gap)
        self._progress.update((number, now))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, latest = self._progress.get()
        held = list(self._waiting.get())
        if held:
            frame = pd.DataFrame(held, columns=self._names)
            self._waiting.clear()
            self._progress.update((number + 1, latest))
            yield self._reduce(key, number, frame[self._columns])

    def close(self) -> None:
        pass


def timed_windows(
    df: DataFrame, key, order_by, window_size: int | Callable[[tuple], int], reduce: Callable, schema: str,
    event_time: str, delay: str, quiet_ms: int,
) -> DataFrame:
    """Every ``window_size`` rows of a key, reduced by ``reduce(key, number, frame) -> frame``; quiet keys give short windows.

    The waiting rows of a key, fewer than a window, come out as a window of their own once the watermark, ``delay``
    behind the latest ``event_time`` of the stream, is ``quiet_ms`` past the key's last row.  So the result depends on the rows'
    times and not on the clock: a stream that ends with one later row (of any key) has given out all others.

    Rows behind the watermark, and rows without an event time, are dropped.  Rows of a null key are a key.  Rows of one micro-batch are put in order of ``order_by``;
    a task holds one key's rows of a micro-batch and fewer than ``window_size`` from before.
    Start the query inside :func:`column_state`.
    """
    require_new(df, _DUE)
    order = as_list(order_by)
    kept = df.withColumn(event_time, F.col(event_time).cast("timestamp")).where(F.col(event_time).isNotNull())
    kept = kept.withColumn(_DUE, F.unix_millis(event_time)).withWatermark(event_time, delay)
    processor = _Windows(kept.schema, order, window_size, reduce, int(quiet_ms))
    return kept.groupBy(*as_list(key)).transformWithStateInPandas(processor, schema, "Append", "EventTime")


class _Scan(StatefulProcessor):
    def __init__(self, names: list[str], order: list[str], state: str, initial: tuple, emit: Callable):
        self._names, self._order, self._state, self._initial, self._emit = names, order, state, tuple(initial), emit

    def init(self, handle) -> None:
        self._held = handle.getValueState("held", self._state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._held.get() or self._initial
        fresh = _arrived(rows, self._names, self._order)
        if len(fresh):
            held, out = self._emit(held, fresh)
            self._held.update(tuple(held))
            yield out

    def close(self) -> None:
        pass


def typed_scan(df: DataFrame, key, order_by, state: str, initial: tuple, emit: Callable, schema: str) -> DataFrame:
    """Stateful map per key: ``emit(held, frame) -> (held, out)`` for each micro-batch of a key's rows.

    ``held`` is a tuple of the columns that ``state`` names, ``initial`` at a key's first rows.  Start the query inside :func:`column_state`.
    """
    return df.groupBy(*as_list(key)).transformWithStateInPandas(_Scan(df.columns, as_list(order_by), state, initial, emit), schema, "Append", "None")
