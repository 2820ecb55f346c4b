"""Long strings that occur more than once, by a logarithmic family of sparse suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import per_process, release, stored, utf8

#: Bytes of a repeated string, and bytes by which suffixes are sampled and ordered.
LENGTH, PREFIX = 200, 64
#: The longest string that can be asked for.
LONGEST = 4096
#: Batches into which documents are dealt by hash.
BATCHES = 4
#: Segments of one prefix that a single task compares; those of more common prefixes are compared window by window.
TOGETHER = 16384
#: Segments that are compared at a time, as far as prefixes allow.
STEP = 8192
#: Bytes that are hashed at a time; longer texts are cut, with an overlap.
PIECE = 2 << 20

ANCHORS = "gram long, seg long, key long, mark long, at long, n int, lead int"
SEGMENTS = "gram long, seg long, key long, mark long, at long, n int, lead int, single boolean, hot boolean, content binary"
WINDOWS = "window long, key long, mark long, at long, single boolean"
SPANS = "key long, mark long, start long, stop long"


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the rolling hash: one for each byte, powers of the base, and their inverses, modulo 2**64."""
    rng = np.random.default_rng(20240229)
    base = 0x9E3779B97F4A7C15
    n = PIECE + 2 * LONGEST + 1
    ahead, back = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    ahead[0] = back[0] = 1
    return rng.integers(0, 1 << 64, 256, np.uint64, endpoint=False), np.cumprod(ahead), np.cumprod(back)


class Rolling:
    """Hashes of any stretches of an array of bytes."""

    def __init__(self, data: np.ndarray):
        bytes_, self.ahead, self.back = per_process("repeats tables", _tables)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(bytes_[data] * self.ahead[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stops] - self.sums[starts]) * self.back[starts])

    def all(self, size: int) -> np.ndarray:
        """Of every stretch of that size."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.back[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of so many values."""
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    block = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def sampled(data: np.ndarray, length: int, prefix: int) -> tuple[np.ndarray, ...] | None:
    """The sampled suffixes of a stretch of text, each with the windows that chose it.

    Every window of ``length`` bytes chooses the suffix whose prefix has the least hash among those that lie in it
    whole, the leftmost of equals.  So equal windows choose the same place, and windows that choose one
    place follow each other.

    :returns: hash of the prefix, hash of the bytes of all its windows, where the first window starts, how many there
        are, and how far behind the first window's start the suffix lies.
    """
    if len(data) < length:
        return None
    hashes = Rolling(data)
    grams = hashes.all(prefix)
    order = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
    places = (_least(order, length - prefix + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    n = np.diff(np.r_[first, len(places)])
    place = places[first]
    return grams[place], hashes.of(first, first + n - 1 + length), first, n, place - first


def _stretches(data: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """A text in stretches that together have each window once, with their starts."""
    for at in range(0, max(len(data) - length + 1, 0), PIECE):
        yield at, data[at:at + PIECE + length - 1]


def _text(df: DataFrame, id_col: str, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("key"), F.xxhash64(text).alias("mark"), text.alias("text"), *keep)


def suffixes(docs: DataFrame, length: int, prefix: int) -> DataFrame:
    """The sampled suffixes of all texts, one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column(2))
            found, rows = [], []
            for row, (i, j) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                for at, part in _stretches(data[i:j], length):
                    gram, seg, first, n, lead = sampled(part, length, prefix)
                    found.append((gram, seg, first + at, n, lead))
                    rows.append(np.full(len(gram), row))
            if found:
                gram, seg, at, n, lead = (np.concatenate(c) for c in zip(*found))
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(seg.view(np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(at), pa.array(n.astype(np.int32)), pa.array(lead.astype(np.int32))],
                    [c.split()[0] for c in ANCHORS.split(", ")])

    return docs.mapInArrow(run, ANCHORS)


class Family:
    """Sorted suffix tables of batches, of which equally large ones are merged: logarithmically many.

    A level has one row for each prefix, in the order of prefixes, with the place of a suffix and whether it has been
    met again.  Levels hold a power of two of batches each.
    """

    def __init__(self):
        self.levels: list[tuple[int, DataFrame, object]] = []

    def add(self, batch: DataFrame, last: bool = False) -> DataFrame:
        """Sort a batch's suffixes, scan them against all levels, and merge levels of equal size.

        :param last: nothing will be added, so that merging can be left out.
        :returns: the prefixes that are met again in this batch: in itself, or in a level.
        """
        own, drop = stored(self._sorted(batch.select("gram", F.struct("key", "mark", "at", "lead").alias("place"), F.lit(1).alias("n"))), "suffixes")
        scan = own.select("gram", "n", F.lit(True).alias("fresh"))
        for _, level, _ in self.levels:
            scan = scan.unionByName(level.select("gram", "n", F.lit(False).alias("fresh")))
        again = scan.groupBy("gram").agg(F.sum("n").alias("n"), F.max("fresh").alias("fresh")).where("n > 1 and fresh").select("gram")
        again, _ = stored(again, "again")
        self.levels.append((1, own, drop))
        while not last and len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a, drop_a), (_, b, drop_b) = self.levels.pop(), self.levels.pop()
            merged, drop = stored(self._sorted(a.unionByName(b)), "suffixes")
            drop_a()
            drop_b()
            self.levels.append((2 * size, merged, drop))
        return again

    def close(self) -> None:
        for _, _, drop in self.levels:
            drop()

    @staticmethod
    def _sorted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("gram").agg(F.sum("n").cast("int").alias("n"), F.min("place").alias("place")).sortWithinPartitions("gram")


def _contents(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted segments, read from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column(2))
            lists = batch.column(3)
            items = lists.flatten()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            starts = items.field("at").to_numpy() + bounds[:-1][row]
            stops = starts + items.field("n").to_numpy() - 1 + length
            raw = data.tobytes()
            content = pa.array([raw[i:j] for i, j in zip(starts.tolist(), stops.tolist())], pa.binary())
            places = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [items.field("gram"), items.field("seg"), batch.column(0).take(places), batch.column(1).take(places), items.field("at"),
                 items.field("n"), items.field("lead"), items.field("single"), items.field("hot"), content],
                [c.split()[0] for c in SEGMENTS.split(", ")])

    lists = wanted.groupBy(F.col("key").alias("w_key"), F.col("mark").alias("w_mark")).agg(
        F.collect_list(F.struct("gram", "seg", "at", "n", "lead", "single", "hot")).alias("items"))
    once = docs.join(lists.hint("merge"), F.col("key").eqNullSafe(F.col("w_key")) & (F.col("mark") == F.col("w_mark"))).select(
        "key", "mark", "text", "items")
    return once.mapInArrow(run, SEGMENTS)


def _windows(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of segments: the row, the place in the row, and a hash of prefix, lead and bytes."""
    content = batch.column("content")
    data, bounds = utf8(content)
    n, lead = batch.column("n").to_numpy(), batch.column("lead").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(batch.num_rows), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    gram = batch.column("gram").to_numpy().view(np.uint64)
    out = np.empty(len(row), np.uint64)
    begin = 0
    while begin < batch.num_rows:  # as much as the tables of powers reach
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + PIECE, "right")) - 1)
        hashes = Rolling(data[bounds[begin]:bounds[end]])
        own = (row >= begin) & (row < end)
        starts = bounds[row[own]] - bounds[begin] + step[own]
        out[own] = hashes.of(starts, starts + length)
        begin = end
    return row, step, mixed(out + gram[row] * np.uint64(3) + (lead[row] - step).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _spans_of(batch: pa.RecordBatch, row: np.ndarray, step: np.ndarray, length: int) -> pa.RecordBatch:
    """Stretches covered by windows that follow each other, of rows in their order."""
    new = np.r_[True, (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)] if len(row) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(row)] - 1 if len(first) else first
    at = batch.column("at").to_numpy()
    rows = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [batch.column("key").take(rows), batch.column("mark").take(rows), pa.array(at[row[first]] + step[first]),
         pa.array(at[row[last]] + step[last] + length)], ["key", "mark", "start", "stop"])


def _compared(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Segments in the order of their prefixes: the stretches of single ones that another segment has, too."""

    def settle(batch: pa.RecordBatch):
        row, step, window = _windows(batch, length)
        _, which, count = np.unique(window, return_inverse=True, return_counts=True)
        covered = (count[which] > 1) & batch.column("single").to_numpy(zero_copy_only=False)[row]
        return _spans_of(batch, row[covered], step[covered], length)

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        gram = batch.column("gram").to_numpy()
        cut = int(np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])[-1])  # the last prefix may go on
        rest = batch.slice(cut)
        for i in range(0, cut, STEP):  # never between segments of one prefix
            lo = int(np.searchsorted(gram[:cut], gram[i], "left")) if i else 0
            hi = cut if i + (STEP) >= cut else int(np.searchsorted(gram[:cut], gram[i + (STEP)], "left"))
            if hi > lo:
                yield settle(batch.slice(lo, hi - lo))
    if rest is not None and rest.num_rows:
        yield settle(rest)


def _window_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, step, window = _windows(batch, length)
        rows = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(window.view(np.int64)), batch.column("key").take(rows), batch.column("mark").take(rows),
             pa.array(batch.column("at").to_numpy()[row] + step), batch.column("single").take(rows)],
            ["window", "key", "mark", "at", "single"])


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, prefix: int = PREFIX) -> DataFrame:
    """Stretches of bytes that are covered by strings of ``length`` bytes which also start anywhere else.

    Documents are dealt into batches by hash.  Each batch's sampled suffixes become a sorted table, which is scanned
    against the tables before it; see :class:`Family`.  Suffixes whose prefix was met again are candidates.
    Those whose whole surroundings (all windows that chose them) occur twice are settled by counting hashes.  The
    others are compared within their prefix, byte strings side by side; where a prefix has more different
    surroundings than a task should hold, window by window over the cluster.

    :returns: ``(key, mark, start, stop)`` in UTF-8 bytes; stretches may touch or overlap, and repeat for copies.
        ``mark`` is the text's hash, which tells texts of one key apart.
    """
    if not 8 <= prefix < length <= LONGEST:
        raise ValueError(f"the prefix must be shorter than the string, which has at most {LONGEST} bytes")
    docs = _text(df, id_col, text_col)
    part = F.pmod(F.xxhash64("mark", F.lit("batch")), F.lit(BATCHES)).cast("int")
    anchors, drop_anchors = stored(suffixes(docs, length, prefix).withColumn("batch", part), "anchors", ["batch"])
    family, again = Family(), None
    for number in range(BATCHES):
        found = family.add(anchors.where(F.col("batch") == number), last=number == BATCHES - 1)
        again = found if again is None else again.unionByName(found)
        release(df.sparkSession)
    family.close()
    # a prefix is met again in a batch or between batches; each batch's scan names it once
    again, drop_again = stored(again.distinct(), "again")
    candidates, drop_candidates = stored(anchors.drop("batch").join(again.hint("merge"), "gram", "left_semi"), "candidates")
    drop_again()
    drop_anchors()
    release(df.sparkSession)
    shape = ["gram", "seg", "n", "lead"]
    kinds, drop_kinds = stored(candidates.groupBy(*shape).agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "mark", "at")).alias("one")), "kinds")
    open_, drop_open = stored(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("times").alias("low")).where(
        "kinds > 1 and low = 1").select("gram", (F.col("kinds") > TOGETHER).alias("hot")), "open")
    wanted = kinds.join(open_.hint("merge"), "gram").select(
        *shape, "hot", (F.col("times") == 1).alias("single"), F.col("one.key").alias("key"), F.col("one.mark").alias("mark"), F.col("one.at").alias("at"))
    segments, drop_segments = stored(_contents(docs, wanted, length), "segments")
    release(df.sparkSession)
    together = (
        segments.where("not hot").repartition("gram").sortWithinPartitions("gram").mapInArrow(lambda b: _compared(b, length), SPANS))
    windows, drop_windows = stored(segments.where("hot").mapInArrow(lambda b: _window_rows(b, length), WINDOWS), "windows")
    twice, drop_twice = stored(windows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window"), "twice")
    apart = windows.where("single").join(twice.hint("merge"), "window", "left_semi").select(
        "key", "mark", F.col("at").alias("start"), (F.col("at") + length).alias("stop"))
    whole = candidates.join(kinds.where("times > 1").select(*shape).hint("merge"), shape, "left_semi").select(
        "key", "mark", F.col("at").alias("start"), (F.col("at") + F.col("n") - 1 + length).alias("stop"))
    spans, _ = stored(whole.unionByName(together).unionByName(apart), "spans")
    for drop in (drop_candidates, drop_kinds, drop_open, drop_segments, drop_windows, drop_twice):
        drop()
    release(df.sparkSession)
    return spans


def _joined_runs(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that touch or overlap as one."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.r_[True, starts[1:] > stops[:-1]]
    return starts[new], stops[np.r_[np.flatnonzero(new)[1:] - 1, len(stops) - 1]]


def without_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, prefix: int = PREFIX, text: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every row's text without the bytes of repeated strings.

    Each byte covered by a string of ``length`` bytes that also starts anywhere else, in the same text or another, goes:
    all occurrences alike, judged on the input.  Null and empty texts have no byte.  Repeated rows, and rows
    with null keys, are texts of their own, so their long strings are repeated.  Columns other than the two named
    are not read.

    :param text: also return ``kept``, the text as a string; a character of which any byte goes, goes whole.
    :param keep: further columns to return, not named like those of the result.
    :returns: ``(key, mark, n_bytes, n_removed, n_spans, kept_sha256)``; spans are maximal removed runs.
    """
    spans = repeated_spans(df, id_col, text_col, length, prefix)
    lists = spans.groupBy(F.col("key").alias("s_key"), F.col("mark").alias("s_mark")).agg(
        F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = _text(df, id_col, text_col, keep).join(
        lists.hint("merge"), F.col("key").eqNullSafe(F.col("s_key")) & (F.col("mark") == F.col("s_mark")), "left").select(
        "key", "mark", "text", "spans", *keep)
    schema = "key long, mark long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * text
    names = [c.split()[0] for c in schema.split(", ")] + list(keep)
    schema += "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column(2))
            out = [[] for _ in range(5)]
            for row, (i, j) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                own, found = data[i:j], batch.column(3)[row]
                left = own
                removed = runs = 0
                if found.is_valid:
                    starts, stops = _joined_runs(found.values.field("start").to_numpy(), found.values.field("stop").to_numpy())
                    keep = np.ones(len(own) + 1, np.int64)
                    np.add.at(keep, starts, -1)
                    np.add.at(keep, stops, 1)
                    keep = np.cumsum(keep - 1)[:-1] == 0
                    removed, runs = len(own) - int(keep.sum()), len(starts)
                    left = own[keep]
                    if text:
                        lead = (own & 0xC0) != 0x80
                        character = np.cumsum(lead) - 1
                        whole = np.bincount(character, ~keep) == 0
                        left_text = own[whole[character]]
                elif text:
                    left_text = own
                for column, value in zip(out, (len(own), removed, runs, hashlib.sha256(left.tobytes()).hexdigest())):
                    column.append(value)
                if text:
                    out[4].append(left_text.tobytes().decode("utf-8"))
            columns = [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string())]
            if text:
                columns.append(pa.array(out[4], pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[4:]], names)

    return rows.mapInArrow(run, schema)
