"""Look-ups of arrays where their rows are: small tables held by every worker, whole Arrow batches at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes that a table may have to be sent to workers.
MOST_BYTES = 64 << 20
#: Items whose vectors a worker holds at a time.
ITEMS = 1 << 16


def held(table: DataFrame, size: Column, name: str):
    """The table on every worker, if the sum of its rows' ``size`` is small.  Larger ones are for :func:`per_micro_batch`."""
    found = table.agg(F.sum(size)).first()[0] or 0
    if found > MOST_BYTES:
        raise ValueError(f"{name} has {found} bytes, more than the {MOST_BYTES} that a stream looks up arrays in: use per_micro_batch")
    return table.sparkSession.sparkContext.broadcast(table.toArrow().combine_chunks())


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table[name]
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def _bounds(lists: pa.Array) -> np.ndarray:
    """Where each list's items begin in the flattened array."""
    return np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))].astype(np.int64)


def places(table: DataFrame, name: str):
    """A function of an array of texts: their ids in a table ``(value, id)``, null for those that are not there."""
    sent = held(table, F.octet_length("value") + F.lit(12), name)

    @F.arrow_udf("array<bigint>")
    def look_up(texts: pa.Array) -> pa.Array:
        items = texts.flatten()
        at = pc.index_in(items, value_set=_column(sent.value, "value").cast(items.type))
        ids = _column(sent.value, "id").take(at)
        return pa.ListArray.from_arrays(pa.array(_bounds(texts), pa.int32()), ids, mask=texts.is_null())

    return look_up


def combined(table: DataFrame, name: str, d: int, combiner: str):
    """A function of an array of ids: their vectors of ``d`` numbers in a table ``(id, vector)`` put together."""
    faults = table.agg((F.count("id") - F.count_distinct("id")).alias("again"), F.max(F.exists("vector", lambda v: v.isNull())).alias("gaps")).first()
    if faults["again"] or faults["gaps"]:
        raise ValueError(f"{name} needs weights without repeated ids and without nulls on a stream")
    return _combining(held(table, F.lit(8 * (d + 1)), name), d, combiner)


def combined_if_plain(table: DataFrame, d: int, combiner: str):
    """The same for a table that is known to be small; None if it repeats an id or holds null numbers."""
    known = table.toArrow().combine_chunks()
    if len(pc.unique(_column(known, "id"))) < known.num_rows or _column(known, "vector").flatten().null_count:
        return None
    return _combining(table.sparkSession.sparkContext.broadcast(known), d, combiner)


def _combining(sent, d: int, combiner: str):
    @F.arrow_udf("array<double>")
    def look_up(ids: pa.Array) -> pa.Array:
        known = sent.value
        vectors = _column(known, "vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        at = pc.index_in(ids.flatten().cast(pa.int64()), value_set=_column(known, "id"))
        row = np.repeat(np.arange(len(ids)), np.diff(_bounds(ids)))[at.is_valid().to_numpy(zero_copy_only=False)]
        at = at.drop_null().to_numpy()
        sums, times = np.zeros((len(ids), d)), np.bincount(row, minlength=len(ids)).astype(float)
        for start in range(0, len(at), ITEMS):
            rows = row[start:start + ITEMS]
            first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
            sums[rows[first]] += np.add.reduceat(vectors[at[start:start + ITEMS]], first, axis=0)
        by = {"sum": np.ones_like(times), "mean": times, "sqrtn": np.sqrt(times)}[combiner]
        out = sums / np.where(times > 0, by, 1.0)[:, None]
        return pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * d, pa.int32()), pa.array(out.ravel()))

    return look_up
