"""Fill-in-the-middle: texts cut in three at token ends that rank queries on a wavelet matrix locate."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import per_process, pieces, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Classes of code points, and what stands for the end of the text.
SPACE, BREAK, OTHER, END = range(4)
#: A symbol is the class of a code point times four, plus that of the next one.  At these a token ends:
#: a word before white space or the end, and white space before the end.
ENDINGS = tuple(4 * a + b for a, b in ((OTHER, SPACE), (OTHER, BREAK), (OTHER, END), (SPACE, END), (BREAK, END)))
LEVELS = 4


class _Bits:
    """A sequence of bits that counts those set before any place: words of 64 and the count before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, places: np.ndarray) -> np.ndarray:
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        inside = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)


class WaveletMatrix:
    """Rank queries over a sequence of small numbers: one sequence of bits for each binary digit, highest first."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.levels, self.zeros = [], []
        for digit in range(levels - 1, -1, -1):
            bits = (symbols >> digit & 1).astype(bool)
            self.levels.append(_Bits(bits))
            self.zeros.append(len(bits) - int(bits.sum()))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))  # stable: zeros before ones

    def rank(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """How often the symbol stands before each place."""
        low, at = np.zeros(1, np.int64), np.asarray(places, np.int64)
        for digit, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            if symbol >> (len(self.levels) - 1 - digit) & 1:
                low, at = zeros + bits.ones(low), zeros + bits.ones(at)
            else:
                low, at = low - bits.ones(low), at - bits.ones(at)
        return at - low

    def endings(self, places: np.ndarray) -> np.ndarray:
        """How many tokens end before each place."""
        return sum(self.rank(symbol, places) for symbol in ENDINGS)


def symbols_of(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The symbols of texts that lie end to end, from each code point's first byte."""
    kinds = np.full(len(points) + 1, OTHER, np.uint8)
    kinds[:-1][points == 0x20] = SPACE
    kinds[:-1][(points >= 0x09) & (points <= 0x0D)] = BREAK
    after = kinds[1:].copy()
    stops = bounds[1:][bounds[1:] > bounds[:-1]] - 1  # the last code point of each text that has one
    after[stops] = END
    return kinds[:-1] * np.uint8(4) + after


def located(matrix: WaveletMatrix, starts: np.ndarray, stops: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Where the first so many tokens of each text end, by bisection on ranks."""
    wanted = matrix.endings(starts) + tokens
    low, high = starts.copy(), stops.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        enough = matrix.endings(middle) >= wanted
        high = np.where(open_ & enough, middle, high)
        low = np.where(open_ & ~enough, middle + 1, low)
    return low


def restored(output: bytes, form: str) -> bytes:
    """The text from its transformed form; the marks stand nowhere else in it."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE, 1)
    if form == "psm":
        prefix, suffix = head[len(PREFIX):].split(SUFFIX, 1)
    else:
        suffix, prefix = head[len(SUFFIX):].split(PREFIX, 1)
    return prefix + middle + suffix


def _draws(key: Column) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of ``42:`` and the key."""
    digest = F.sha2(F.concat(F.lit("42:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 50, spm_share: int = 80, texts: bool = True,
) -> DataFrame:
    """Texts with a middle part moved to the end, for training to fill it in.

    Tokens are runs of other characters with the white space before them, and white space at the end.  Two numbers drawn
    from the key choose how many tokens come before either cut.  ``share`` of a hundred texts are transformed, of these
    ``spm_share`` of a hundred to suffix, prefix, middle and the rest to prefix, suffix, middle.  Texts that are null,
    empty or hold a mark stay ``plain``.  One pass without a shuffle; texts are cut whole, at whole code points, and a text
    larger than a piece is a piece of its own.  Rows that repeat stay, each by itself, and equal keys draw alike; a null
    key draws as an empty one.  No row gives no row.

    :param texts: also return ``output``, the transformed text.
    :returns: ``(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_process("infill", bool)  # what other operators keep goes
        for whole in batches:
            for batch in pieces(whole, "text"):
                yield _transformed(batch, share, spm_share, texts)

    schema = ("key long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
              + (", output string" if texts else ""))
    key = F.col(id_col).cast("long")
    return df.select(key.alias("key"), F.col(text_col).cast("string").alias("text"), *_draws(key)).mapInArrow(run, schema)


def _transformed(batch: pa.RecordBatch, share: int, spm_share: int, texts: bool) -> pa.RecordBatch:
    data, bounds = utf8(batch.column(1))
    h1, h2, h3, h4 = (batch.column(k).to_numpy() for k in range(2, 6))
    leads = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a code point
    places = np.searchsorted(leads, bounds)
    matrix = WaveletMatrix(symbols_of(data[leads], places))
    starts, stops = places[:-1], places[1:]
    n = matrix.endings(stops) - matrix.endings(starts)
    one, two = h1 % (n + 1), h2 % (n + 1)
    cuts = [located(matrix, starts, stops, k) for k in (np.minimum(one, two), np.maximum(one, two))]
    ends = np.r_[leads, len(data)]
    raw, rows = data.tobytes(), {name: [] for name in ("form", "output_sha256", "restored_sha256", "output")}
    for i, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
        text = raw[a:b]
        if not text or h3[i] % 100 >= share or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            form, output = "plain", text
        else:
            x, y = int(ends[cuts[0][i]]) - a, int(ends[cuts[1][i]]) - a
            prefix, middle, suffix = text[:x], text[x:y], text[y:]
            form = "spm" if h4[i] % 100 < spm_share else "psm"
            parts = (SUFFIX, suffix, PREFIX, prefix) if form == "spm" else (PREFIX, prefix, SUFFIX, suffix)
            output = b"".join((*parts, MIDDLE, middle))
        rows["form"].append(form)
        rows["output_sha256"].append(hashlib.sha256(output).hexdigest())
        rows["restored_sha256"].append(hashlib.sha256(restored(output, form)).hexdigest())
        if texts:
            rows["output"].append(output)
    plain = np.array([form == "plain" for form in rows["form"]], bool)
    columns = [
        batch.column(0), pa.array(n, pa.int64()), pa.array(rows["form"], pa.string()),
        pa.array(cuts[0] - starts, pa.int64(), mask=plain), pa.array(cuts[1] - cuts[0], pa.int64(), mask=plain),
        pa.array(rows["output_sha256"], pa.string()), pa.array(rows["restored_sha256"], pa.string())]
    names = ["key", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    if texts:
        columns.append(pa.array(rows["output"], pa.binary()).cast(pa.string()))
        names.append("output")
    return pa.RecordBatch.from_arrays(columns, names)
