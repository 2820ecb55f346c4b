"""A quality score by the labels of a text's nearest neighbours in a latent space.

The space reduces three families of terms: pairs of byte kinds with word lengths and repeated words, hashed words, and
hashed runs of three code points, which speak for any script.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordinate.llm.common import per_process, pieces, utf8

#: Labelled texts of each label that are kept, chosen by a hash of their ids; dimensions of the latent space; neighbours that vote.
LABELLED, DIMENSIONS, NEIGHBOURS = 2048, 48, 15
#: Says that words and runs may have beside bytes; the voters choose, each judged by all others.
SHARES = (0.0, 0.25, 0.5, 1.0)
#: Rows whose neighbours are looked for at a time.
ROWS = 512
#: Bytes of a text that are counted at a time.
STRETCH = 1 << 20

#: Bytes that count as one when pairs of neighbouring bytes are counted; all others are letters or marks by their kind.
GROUPS = ["a", "e", "i", "o", "u", "bdg", "ptk", "fvw", "szc", "lr", "mn", "h", "jqxy", "AEIOU", "0123456789", " ", "\n", "\t\r\x0b\x0c",
          ".", ",", "!", "?", "|", "$", "%", "&", "#", "*", ":;", "\"'`", "()[]{}<>", "/\\", "@", "=+", "-_~^"]
CAPITALS, CONTROL, LEAD, MIDDLE = (len(GROUPS) + k for k in range(4))
KINDS = len(GROUPS) + 4
#: Further terms: words by length, words equal to the one before, and to the one before that.
LENGTHS = 16
TERMS = KINDS * KINDS + LENGTHS + 2
#: Places that words, and runs of ``RUN`` code points, are hashed to.
WORDS, RUNS, RUN = 2048, 2048, 3
#: Where the families of terms begin: bytes and lengths, words, runs of code points.
FAMILIES = np.cumsum([0, TERMS, WORDS, RUNS])
EVERY = int(FAMILIES[-1])


def _kinds() -> np.ndarray:
    out = np.full(256, CONTROL, np.int32)
    out[ord("A"):ord("Z") + 1] = CAPITALS
    for number, group in enumerate(GROUPS):
        out[[ord(c) for c in group]] = number
    out[0x80:0xC0], out[0xC0:] = MIDDLE, LEAD
    return out


def _read(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` bytes, eight at most, from each place as one number."""
    windows = np.ndarray(len(data) + 8, "<u8", np.r_[data, np.zeros(16, np.uint8)].tobytes(), strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    return windows[at] & masks[np.minimum(size, 8)]


def _hashed(parts: list[np.ndarray], places: int) -> np.ndarray:
    """A place for each row of numbers."""
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return (out % np.uint64(places)).astype(np.int64)


def _add(out: np.ndarray, family: int, own: np.ndarray, place: np.ndarray) -> None:
    begin, end = FAMILIES[family], FAMILIES[family + 1]
    width = end - begin
    out[:, begin:end] += np.bincount(own * width + place, minlength=len(out) * width).reshape(len(out), width)


def _counted(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of every term in texts that lie end to end: one row for each."""
    texts = len(bounds) - 1
    out = np.zeros((texts, EVERY), np.float32)
    if not len(data):
        return out
    text = np.repeat(np.arange(texts), np.diff(bounds))
    kind = per_process("quality kinds", _kinds)[data]
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    inside = text[1:] == text[:-1]
    pairs = (text[:-1] * KINDS + kind[:-1]) * KINDS + kind[1:]
    out[:, :KINDS * KINDS] = np.bincount(pairs[inside], minlength=texts * KINDS * KINDS).reshape(texts, -1)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.r_[True, ~inside]
    begins = np.flatnonzero(~blank & (first | np.r_[True, blank[:-1]]))
    if len(begins):
        ends = np.flatnonzero(~blank & (np.r_[first[1:], True] | np.r_[blank[1:], True])) + 1
        sizes, own = ends - begins, text[begins]
        head, tail = _read(data, begins, sizes), _read(data, np.maximum(ends - 8, begins), sizes)
        base = KINDS * KINDS
        np.add.at(out, (own, base + np.minimum(sizes, LENGTHS) - 1), 1)
        for back in (1, 2):
            if len(begins) > back:
                same = (head[back:] == head[:-back]) & (tail[back:] == tail[:-back]) & (sizes[back:] == sizes[:-back]) & (own[back:] == own[:-back])
                np.add.at(out, (own[back:][same], base + LENGTHS + back - 1), 1)
        _add(out, 1, own, _hashed([_read(lower, begins, sizes), _read(lower, np.maximum(ends - 8, begins), sizes), sizes], WORDS))
    points = np.flatnonzero((data & 0xC0) != 0x80)
    if len(points) >= RUN:
        values, owner = _read(lower, points, np.minimum(np.diff(np.r_[points, len(data)]), 4)), text[points]
        whole = owner[RUN - 1:] == owner[:1 - RUN]
        runs = _hashed([values[k:len(values) - RUN + 1 + k] for k in range(RUN)], RUNS)
        _add(out, 2, owner[RUN - 1:][whole], runs[whole])
    return out


def _few(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``ROWS`` rows and ``PIECE`` bytes, whose counts are held together."""
    for piece in pieces(batch, text):
        for at in range(0, piece.num_rows, ROWS):
            yield piece.slice(at, ROWS)


def term_counts(column: pa.Array) -> np.ndarray:
    """Pairs of bytes, word lengths and repeats of whole texts."""
    return every_count(column)[:, :TERMS]


def every_count(column: pa.Array) -> np.ndarray:
    """The terms of whole texts, of all families.  Texts longer than ``STRETCH`` are counted in stretches and added up."""
    data, bounds = utf8(column)
    cuts, owner = [0], []
    for row, (i, j) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        more = list(range(i + STRETCH, j, STRETCH)) + [j]
        cuts.extend(more)
        owner.extend([row] * len(more))
    counts = _counted(data, np.array(cuts))
    if len(owner) == len(bounds) - 1:
        return counts
    out = np.zeros((len(bounds) - 1, EVERY), np.float32)
    np.add.at(out, np.array(owner), counts)
    return out


#: A term that a text has, and how often.
PACKED = np.dtype([("term", "<u2"), ("count", "<f4")])


def packed(row: np.ndarray) -> bytes:
    """A text's terms without those that it lacks."""
    met = np.flatnonzero(row)
    out = np.empty(len(met), PACKED)
    out["term"], out["count"] = met, row[met]
    return out.tobytes()


@dataclass
class Model:
    """Weights of terms, the say of words and runs, the latent space, and the labelled vectors in it."""

    weights: np.ndarray
    share: float
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return unit(scaled(counts, self.weights, self.share) @ self.space)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Votes of the nearest labelled vectors, by exact cosines over blocks of rows."""
        out = np.full(len(counts), float(self.labels.mean()) if len(self.labels) else 0.5)
        out[~counts.any(axis=1)] = min(out[0], 0.5) if len(out) else 0.0  # nothing speaks for them
        some = np.flatnonzero(counts.any(axis=1))
        if len(set(self.labels.tolist())) < 2:
            return out
        for at in range(0, len(some), ROWS):
            rows = some[at:at + ROWS]
            out[rows] = self.votes(self.latent(counts[rows]) @ self.vectors.T)
        return np.clip(out, 0.0, 1.0)

    def votes(self, cosine: np.ndarray) -> np.ndarray:
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 4 + 1e-12
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)

    def error(self) -> float:
        """Mean squared error of the vote on each voter by all others."""
        wrong = 0.0
        for at in range(0, len(self.labels), ROWS):
            rows = np.arange(at, min(at + ROWS, len(self.labels)))
            cosine = self.vectors[rows] @ self.vectors.T
            cosine[np.arange(len(rows)), rows] = -2  # no say in its own case
            wrong += float(((self.votes(cosine) - self.labels[rows]) ** 2).sum())
        return wrong / max(1, len(self.labels))


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.maximum(size, 1e-12)).astype(np.float32)


def scaled(counts: np.ndarray, weights: np.ndarray, share: float) -> np.ndarray:
    """Weighted logarithms of counts: bytes have length 1, the other families ``share``."""
    out = np.log1p(counts) * weights
    for family, (begin, end) in enumerate(zip(FAMILIES, FAMILIES[1:])):
        out[:, begin:end] = unit(out[:, begin:end]) * np.float32(share if family else 1.0)
    return out


def held_out(key: Column) -> Column:
    """Whether a row's labels are never learnt from."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def fit(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    labelled: int = LABELLED, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS,
) -> Model:
    """Learn the space and keep the voters.

    At most ``labelled`` texts of each label, 0 and 1, are used: those whose ids have the least hashes among the labelled
    rows that are not held out.  Ids with both labels, null ids and other labels are left out; of rows that repeat an id,
    one text is used.  Words and runs of code points get that one of ``SHARES`` with which the voters judge each other best.
    Only the term counts of these texts reach the driver, a number that the parameter bounds.
    """
    known = (
        labels.select(F.col(id_col).alias("key"), F.col(label_col).alias("label")).where("key is not null and label in (0, 1)")
        .where(~held_out(F.col("key"))).groupBy("key").agg(F.min("label").alias("label"), F.max("label").alias("high"))
        .where("label = high").select("key", "label"))
    least = [known.where(F.col("label") == value).orderBy(F.xxhash64("key"), "key").limit(labelled) for value in (0, 1)]
    chosen = F.broadcast(least[0].unionByName(least[1]))  # at most twice ``labelled`` rows
    texts = df.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).join(chosen, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _few(whole, "text"):
                rows = [packed(r) for r in every_count(batch.column(1))]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], ["key", "label", "terms"])

    counted = texts.select(F.col("key").cast("long"), "text", F.col("label").cast("int")).mapInArrow(run, "key long, label int, terms binary")
    rows = sorted(counted.groupBy("key").agg(F.min("label").alias("label"), F.min("terms").alias("terms")).collect())
    label = np.array([r["label"] for r in rows], np.float64)
    counts = np.zeros((len(rows), EVERY), np.float32)
    for row, r in zip(counts, rows):
        met = np.frombuffer(r["terms"], PACKED)
        row[met["term"]] = met["count"]
    del rows
    return min(_tried(counts, label, dimensions, neighbours), key=Model.error)


def _tried(counts: np.ndarray, labels: np.ndarray, dimensions: int, neighbours: int) -> list[Model]:
    """A model for each of ``SHARES``.  The counts are scaled where they lie: the driver holds them once, for all shares."""
    blocks = [slice(at, at + ROWS) for at in range(0, len(counts), ROWS)]
    seen = sum(((counts[b] > 0).sum(axis=0) for b in blocks), np.zeros(EVERY, np.int64))
    weights = (np.log((1 + len(counts)) / (1 + seen)) + 1).astype(np.float32)
    for b in blocks:
        counts[b] = scaled(counts[b], weights, 1.0)
    return [_reduced(counts, labels, weights, share, dimensions, neighbours) for share in SHARES]


def _reduced(terms: np.ndarray, labels: np.ndarray, weights: np.ndarray, share: float, dimensions: int, neighbours: int) -> Model:
    """The model of terms that are scaled to a share of 1.  Their say is a factor of the space's rows, so that no terms are copied."""
    say = np.where(np.arange(EVERY) < FAMILIES[1], 1, share).astype(np.float32)[:, None]
    space = np.linalg.qr(np.random.default_rng(7).standard_normal((EVERY, dimensions)))[0].astype(np.float32)
    for _ in range(8):  # subspace iteration towards the leading directions
        space = np.linalg.qr(say * (terms.T @ (terms @ (say * space))))[0]
    return Model(weights, share, space, unit(terms @ (say * space)), labels, neighbours)


def score(df: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """The rows with a score from 0 to 1, higher where label 1 is likelier, in one pass without a shuffle.

    The text is all that the score depends on.  Texts without two bytes, empty and null ones get the share of label 1 among
    the voters, but no more than 0.5, so that what says nothing never counts as good; if the voters have one label only, the others
    get that share (0.5 without voters).  A column that has the score's name
    already is an error.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    shared = df.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))  # at most twice ``labelled`` voters
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for whole in batches:
            for batch in _few(whole, text_col):
                scores = pa.array(model.scores(every_count(batch.column(text_col))))
                yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    return df.mapInArrow(run, schema)
