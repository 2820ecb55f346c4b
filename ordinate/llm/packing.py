"""Sequences of bounded length, cut from the documents' tokens in their order by dynamic programming."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordinate.llm.bpe import encoded, vocabulary
from ordinate.llm.common import per_process, pieces

LIMIT = 2048
#: Id that ends a document.
END = 1
#: What a cut costs, in tokens of padding: after a sentence, and elsewhere as a share of the limit.
SENTENCE, INSIDE = 4, 0.25
#: Sentences longer than twice this may be cut every so many tokens.
STRIDE = 16
#: Tokens for which cuts are chosen at a time; the last windows are chosen again with what follows.
HELD = 1 << 20


def best_cuts(places: list[int], costs: list[int], limit: int) -> list[int]:
    """Among places in rising order, from the first to the last, those with the least padding plus costs.

    No window is longer than the limit.  A queue holds the starts that can still be best, best first, so
    that each place enters and leaves it once.  Padding adds up to windows times the limit, less the tokens.
    """
    n = len(places)
    total, back = [0] * n, [0] * n
    queue = deque([0])
    for i in range(1, n):
        low = places[i] - limit
        while places[queue[0]] < low:
            queue.popleft()
        j = back[i] = queue[0]
        cost = total[i] = total[j] + limit + costs[i]
        while queue and total[queue[-1]] > cost:
            queue.pop()
        queue.append(i)
    cuts, i = [n - 1], n - 1
    while i:
        i = back[i]
        cuts.append(i)
    return [places[i] for i in reversed(cuts)]


def _powers(start: int, stop: int, limit: int) -> list[int]:
    """Ends of windows whose lengths are powers of two: no padding there."""
    out = []
    while start < stop:
        start += min(limit, 1 << (stop - start).bit_length() - 1)
        out.append(start)
    return out


def candidates(ids: np.ndarray, ends: np.ndarray, stops: np.ndarray, limit: int) -> tuple[list[int], list[int]]:
    """Where cuts may lie, with their costs: after documents, after sentences, and at steps in long sentences."""
    cost = np.full(len(ids) + 1, -1, np.int32)
    natural = np.unique(np.r_[0, np.flatnonzero(ends[ids]) + 1, stops, len(ids)])
    gaps = np.diff(natural)
    stride = min(STRIDE, limit)
    more = np.where(gaps > 2 * stride, (gaps - 1) // stride, 0)
    inside = np.repeat(natural[:-1], more) + (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1) * stride
    cost[inside] = max(SENTENCE, int(INSIDE * limit))
    cost[natural] = SENTENCE
    cost[stops] = 0
    cost[0] = cost[-1] = 0
    places = np.flatnonzero(cost >= 0)
    return places.tolist(), cost[places].tolist()


class _Stream:
    """The tokens of one task's documents that are not in a sequence yet."""

    def __init__(self, limit: int, ends: np.ndarray, first_sequence: int):
        self.limit, self.ends, self.sequence = limit, ends, first_sequence
        self.docs: list[tuple[object, np.ndarray, int]] = []  # key, ids, how many of them are out
        self.waiting = 0

    def add(self, key, ids: np.ndarray) -> None:
        self.docs.append((key, ids, 0))
        self.waiting += len(ids)

    def flush(self, last: bool) -> dict[str, list]:
        """The pieces of all windows that are decided."""
        ids = np.concatenate([d[1][d[2]:] for d in self.docs]) if self.docs else np.zeros(0, np.int32)
        stops = np.cumsum([len(d[1]) - d[2] for d in self.docs])
        if not len(ids):
            return {}
        bounds = best_cuts(*candidates(ids, self.ends, stops, self.limit), self.limit)
        if last:
            rest = bounds[-2]
            bounds = bounds[:-1] + _powers(rest, len(ids), self.limit)
        else:
            bounds = bounds[:max(1, len(bounds) - 3)]
        return self._pieces(ids, stops, np.array(bounds))

    def _pieces(self, ids: np.ndarray, stops: np.ndarray, bounds: np.ndarray) -> dict[str, list]:
        done = int(bounds[-1])
        starts = np.unique(np.r_[bounds[:-1], stops[stops < done], 0]) if done else np.zeros(0, np.int64)
        ends = np.r_[starts[1:], done][:len(starts)]
        doc = np.searchsorted(stops, starts, "right")
        window = np.searchsorted(bounds, starts, "right") - 1
        begun = np.array([d[2] for d in self.docs], np.int64) - np.r_[0, stops[:-1]]
        out = {
            "key": [self.docs[d][0] for d in doc], "start": starts + begun[doc], "length": ends - starts,
            "ids_crc32": [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist())],
            "doc_tokens": [len(self.docs[d][1]) for d in doc], "sequence_id": self.sequence + window, "offset": starts - bounds[window],
            "ids": [ids[a:b] for a, b in zip(starts.tolist(), ends.tolist())],
        }
        self.sequence += len(bounds) - 1
        kept = int(np.searchsorted(stops, done, "right"))
        before = int(stops[kept - 1]) if kept else 0
        self.docs = self.docs[kept:]
        if self.docs:
            key, whole, at = self.docs[0]
            self.docs[0] = (key, whole, at + done - before)
        self.waiting = len(ids) - done
        return out


def _sentence_ends(path: str) -> np.ndarray:
    """Whether a sentence can end with each id: it ends in a full stop, a question or exclamation mark, or has a line end."""
    return np.array([piece.rstrip(b" \"')").endswith((b".", b"!", b"?")) or b"\n" in piece for piece in vocabulary(path).bytes])


def pack(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, end: int = END, ids: bool = False
) -> DataFrame:
    """Cut all documents, in their order, into sequences of at most ``limit`` tokens.

    Each document's tokens are followed by the id ``end``; a null or empty text has that one only, and an empty
    table gives no rows.  Sequences are cut after documents or sentences; inside a sentence only where it is longer
    than ``limit``, or a quarter of a sequence would be padding else.  Each token lies in exactly one piece.  A text
    of any length is cut like the rest: a task holds its tokens, and at most a million tokens besides.  The order is that in which the rows lie in the input's partitions; every partition is packed by
    itself, in one pass without a shuffle, and its last window is cut to lengths that are powers of two.
    Keys may be null or repeated: each row is a document of its own.

    :param path: the rank file, readable on every executor.
    :returns: a row for each piece: ``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` and, on
        demand, ``ids``.  ``sequence_id`` is the partition's number times 2**32 plus a count.
    """
    kinds = {"key": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
             "sequence_id": pa.int64(), "offset": pa.int64()}
    schema = ", ".join(f"{name} long" for name in kinds)
    if ids:
        kinds["ids"] = pa.list_(pa.int32())
        schema += ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        ends = per_process(f"bpe sentence ends {path}", lambda: _sentence_ends(path))
        stream = _Stream(limit, ends, TaskContext.get().partitionId() << 32)

        def batch_of(rows: dict[str, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[name], kind) for name, kind in kinds.items()], list(kinds))

        for whole in batches:
            for batch in pieces(whole, "text"):
                flat, bounds = encoded(batch.column(1), vocab)
                for key, a, b in zip(batch.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                    stream.add(key, np.append(flat[a:b], np.int32(end)))
                if stream.waiting >= HELD:
                    yield batch_of(stream.flush(False))
        if rows := stream.flush(True):
            yield batch_of(rows)

    return df.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
