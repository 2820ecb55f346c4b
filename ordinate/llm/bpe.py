"""Byte-level BPE: pre-tokens by an associative scan over code point classes, pair merging with a cache."""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import per_process, pieces, utf8

#: Pre-tokens whose ids a process keeps, and the longest one that it keeps, in bytes.
KEPT = 1 << 19
KEPT_BYTES = 64
#: Bytes of whole texts that are encoded at a time: some 30 bytes are held for each meanwhile.
STRETCH = 1 << 20
#: Slots of the table of pairs, as a power of two; and the rank of a pair that does not merge.
PAIR_BITS = 20
NEVER = 1 << 30
#: Symbols that are folded before blocks are combined.
BLOCK = 128

# Symbols: what a code point means for the boundaries, given the code points after it.
LETTER, NUMBER, OTHER, APOSTROPHE_1, APOSTROPHE_2, SPACE, BLANK, BLANKS = range(8)
FIRST = 8  # added to the symbol of a text's first code point
# States: what the next code point continues.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, AFTER_SPACE, ONE_MORE, TWO_MORE = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a pre-token starts at the symbol."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return CLOSED, False
    if symbol == SPACE:  # U+0020 before something else: leads what follows
        return AFTER_SPACE, True
    if symbol == BLANK:  # other white space before something else: stands alone
        return CLOSED, True
    if symbol == BLANKS:  # white space before white space, or before the end
        return IN_BLANKS, state != IN_BLANKS
    if symbol in (APOSTROPHE_1, APOSTROPHE_2) and state not in (IN_OTHERS, AFTER_SPACE):
        return (ONE_MORE if symbol == APOSTROPHE_1 else TWO_MORE), True
    into = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(symbol, IN_OTHERS)
    return into, state not in (into, AFTER_SPACE)


def _machine() -> dict[str, np.ndarray]:
    """All functions from state to state that sequences of symbols amount to, and how they combine.

    There are few, so that a function is a small number, and combining two is a look-up in a table.
    """
    simple = []
    for symbol in range(2 * FIRST):
        kind = symbol % FIRST
        simple.append(tuple(_step(CLOSED if symbol >= FIRST else s, kind)[0] for s in range(8)))
    known = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *simple]))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in simple:
            both = tuple(g[s] for s in f)
            if both not in known:
                known[both] = len(known)
                todo.append(both)
    functions = list(known)
    combine = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint16)
    starts = np.array([[_step(CLOSED if s >= FIRST else state, s % FIRST)[1] for s in range(2 * FIRST)] for state in range(8)])
    return {
        "of_symbol": np.array([known[f] for f in simple], np.uint16), "combine": combine, "n": np.int64(len(functions)),
        "from_closed": np.array([f[CLOSED] for f in functions], np.uint8), "starts": starts,
    }


def _states(symbols: np.ndarray) -> np.ndarray:
    """The state before each symbol, by a scan of functions: fold blocks, scan the blocks, then run each block."""
    m = per_process("bpe machine", _machine)
    n, combine, width = len(symbols), m["combine"].ravel(), m["n"]
    rows = max(1, -(-n // BLOCK))
    padded = np.zeros(rows * BLOCK, np.uint16)
    padded[:n] = m["of_symbol"][symbols]
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    total = columns[0]
    for k in range(1, BLOCK):
        total = combine[total * width + columns[k]]
    step = 1
    while step < rows:  # doubling: each block takes in the one that far ahead of it
        after = total.copy()
        after[step:] = combine[total[:-step] * width + total[step:]]
        total, step = after, 2 * step
    before = np.zeros(rows, np.uint16)
    before[1:] = total[:-1]
    out = np.empty((BLOCK, rows), np.uint8)
    for k in range(BLOCK):
        out[k] = m["from_closed"][before]
        before = combine[before * width + columns[k]]
    return out.T.ravel()[:n]


def _classes() -> np.ndarray:
    """For each code point: LETTER, NUMBER, OTHER, SPACE for U+0020, or BLANK."""
    out = np.full(0x110000, OTHER, np.uint8)
    points = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4").tobytes().decode("utf-32-le")
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", BLANK)):
        for found in regex.finditer(pattern, points):
            i, j = (x + 0x800 * (x >= 0xD800) for x in found.span())
            out[i:j] = kind
    out[0x20] = SPACE
    return out


def boundaries(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point of texts that lie end to end.

    Pre-tokens are those of the usual byte-level pattern: contractions in lower case, runs of letters, numbers or
    others, each with a space before it, and white space, of which the last before something else stands apart.
    """
    if not len(points):
        return np.zeros(0, bool)
    symbols = per_process("bpe classes", _classes)[points]
    first = np.zeros(len(points) + 1, bool)
    first[bounds] = True
    first[-1] = True
    last = first[1:]
    blank = symbols >= SPACE
    next_blank = np.r_[blank[1:], True] | last
    symbols[blank & next_blank] = BLANKS
    marks = np.flatnonzero((points == 0x27) & ~last)
    if len(marks):
        one = points[marks + 1]
        two = np.where(last[marks + 1], 0, points[np.minimum(marks + 2, len(points) - 1)])
        symbols[marks[np.isin(one, [ord(c) for c in "stmd"])]] = APOSTROPHE_1
        pair = one.astype(np.int64) * 0x110000 + two
        symbols[marks[np.isin(pair, [ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")])]] = APOSTROPHE_2
    symbols = symbols + FIRST * first[:-1].astype(np.uint8)
    return per_process("bpe machine", _machine)["starts"][_states(symbols), symbols]


class Vocabulary:
    """Ranks of byte sequences, and the ids of pre-tokens that were met."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.bytes[rank] = piece
        self.names = [str(i) for i in range(len(self.bytes))]
        self.kept: dict[bytes, bytes] = {}

    def merged(self, found: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of pre-tokens: the pair of lowest rank is merged, the leftmost first, until none is left."""
        return [tuple(np.frombuffer(ids, np.int32).tolist()) for ids in self._packed(found)]

    def _packed(self, found: list[bytes]) -> list[bytes]:
        """The same as int32 end to end, in half the memory."""
        out: list = [None] * len(found)
        groups: dict[int, list[int]] = {}
        for i, piece in enumerate(found):
            if (whole := self.ranks.get(piece)) is not None:
                out[i] = whole.to_bytes(4, sys.byteorder)
            elif len(piece) > KEPT_BYTES:
                out[i] = np.array(self._merged_long(piece), np.int32).tobytes()
            else:
                groups.setdefault(max(8, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, places in groups.items():
            for i, ids in zip(places, self._merged_rows([found[i] for i in places], width)):
                out[i] = ids
        return out

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """A hash table of the pairs of ids that merge: keys and ranks, with empty places after each run."""
        ranks, keys, values = self.ranks, [], []
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                if (a := ranks.get(piece[:k])) is not None and (b := ranks.get(piece[k:])) is not None:
                    keys.append(a << 16 | b)
                    values.append(rank)
        table, held = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, np.int32)
        keys, values = np.array(keys, np.int64), np.array(values, np.int32)
        places = _place(keys)
        while len(keys):  # one pair takes each free place; the others try the next one
            places %= len(table)
            free = table[places] < 0
            _, one = np.unique(np.where(free, places, -1 - np.arange(len(places))), return_index=True)
            one = one[free[one]]
            table[places[one]], held[places[one]] = keys[one], values[one]
            rest = np.ones(len(keys), bool)
            rest[one] = False
            keys, values, places = keys[rest], values[rest], places[rest] + 1
        return table, held

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NEVER where they do not merge."""
        table, held = per_process(f"bpe pairs {id(self)}", self._pairs)
        keys = a.astype(np.int64) << 16 | b
        out = np.full(len(keys), NEVER, np.int32)
        rows, places = np.arange(len(keys)), _place(keys)
        while len(rows):
            there = table[places]
            hit = there == keys
            out[rows[hit]] = held[places[hit]]
            on = ~hit & (there >= 0)
            rows, keys, places = rows[on], keys[on], (places[on] + 1) % len(table)
        return out

    def _merged_rows(self, found: list[bytes], width: int) -> list[bytes]:
        """Merges of many short pre-tokens side by side, one merge of each at a time."""
        n = len(found)
        sizes = np.fromiter(map(len, found), np.int64, n)
        single = np.array([self.ranks[bytes([k])] for k in range(256)], np.int32)
        ids = single[np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in found), np.uint8).reshape(n, width)]
        ranks = np.full((n, width - 1), NEVER, np.int32)
        for k in range(width - 1):
            rows = np.flatnonzero(sizes > k + 1)
            if len(rows):
                ranks[rows, k] = self._rank(ids[rows, k], ids[rows, k + 1])
        done, rows = np.zeros((n, width), np.int32), np.arange(n)
        left = sizes.copy()
        while len(rows):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            rank = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NEVER)
            over = rank == NEVER
            done[rows[over], :ids.shape[1]] = ids[over]
            go = ~over
            rows, ids, ranks, at, rank = rows[go], ids[go], ranks[go], at[go], rank[go]
            if not len(rows):
                break
            left[rows] -= 1
            line = np.arange(len(rows))
            ids[line, at] = rank
            columns = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
            columns = np.arange(ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            size = left[rows]
            k = np.flatnonzero(at > 0)
            ranks[k, at[k] - 1] = self._rank(ids[k, at[k] - 1], ids[k, at[k]])
            k = np.flatnonzero(at + 1 < size)
            ranks[k, at[k]] = self._rank(ids[k, at[k]], ids[k, at[k] + 1])
        packed, line = done.tobytes(), 4 * width
        return [packed[at:at + size] for at, size in zip(range(0, line * n, line), (4 * left).tolist())]

    def _merged_long(self, piece: bytes) -> tuple[int, ...]:
        """The same by a heap of pairs, for pieces as long as a text."""
        ranks, n = self.ranks, len(piece)
        after, before, stop = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := ranks.get(piece[i:stop[j]])) is not None:
                heapq.heappush(heap, (rank, i, stop[i], stop[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, middle, end = heapq.heappop(heap)
            j = after[i]
            if stop[i] != middle or j >= n or stop[j] != end or j != middle:
                continue
            stop[i], after[i], stop[j] = end, after[j], -1
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:stop[i]]])
            i = after[i]
        return tuple(out)

    def ids_of(self, found: list[bytes]) -> list[bytes]:
        """Ids of different pre-tokens as int32 end to end, from those kept as far as they are."""
        out = list(map(self.kept.get, found))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if missing:
            if len(self.kept) + len(missing) > KEPT:
                self.kept.clear()
            for i, ids in zip(missing, self._packed([found[i] for i in missing])):
                out[i] = ids
                if len(found[i]) <= KEPT_BYTES:
                    self.kept[found[i]] = ids
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a sequence of ids, and where each id's bytes start in them, with the end."""
        flat, starts, sizes = per_process(f"bpe bytes {id(self)}", self._flat)
        return _gathered(flat, starts[ids], sizes[ids])

    def _flat(self):
        sizes = np.fromiter(map(len, self.bytes), np.int64)
        return np.frombuffer(b"".join(self.bytes), np.uint8), np.cumsum(sizes) - sizes, sizes


def _place(keys: np.ndarray) -> np.ndarray:
    return (keys * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - PAIR_BITS)


def vocabulary(path: str) -> Vocabulary:
    return per_process(f"bpe {path}", lambda: Vocabulary(path))


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of an array end to end, and where each starts in the result, with the end."""
    bounds = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    return flat[np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


def _alike(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of at most 16 bytes: one of each content, and for every run which of them it equals.

    Runs are grouped by a hash of their two words, and compared with the one that stands for them.
    """
    words = np.ndarray(len(data) + 8, "<u8", np.r_[data, np.zeros(16, np.uint8)].tobytes(), strides=(1,))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    low = words[starts] & masks[np.minimum(sizes, 8)]
    high = words[np.minimum(starts + 8, len(data))] & masks[np.clip(sizes - 8, 0, 8)]
    mixed = low * np.uint64(0x9E3779B97F4A7C15) ^ (high + sizes.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed ^= mixed >> np.uint64(29)
    _, one, which = np.unique(mixed, return_index=True, return_inverse=True)
    same = (low == low[one][which]) & (high == high[one][which]) & (sizes == sizes[one][which])
    odd = np.flatnonzero(~same)
    if len(odd):  # hashes that met by chance: each such run stands for itself
        which[odd] = len(one) + np.arange(len(odd))
        one = np.r_[one, odd]
    return one, which


def encoded(column: pa.Array, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a column's texts end to end, and where each text starts among them, with the end.

    Texts are encoded ``STRETCH`` bytes at a time, or one that is longer.
    """
    data, bounds = utf8(column)
    cuts = [0]
    while cuts[-1] < len(column):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(bounds, bounds[cuts[-1]] + STRETCH, "right")) - 1))
    flat, starts, n = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
    for i, j in pairwise(cuts):
        ids, places = _encoded(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], vocab)
        flat.append(ids)
        starts.append(places[1:] + n)
        n += len(ids)
    return np.concatenate(flat), np.concatenate(starts)


def _encoded(data: np.ndarray, bounds: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts that lie end to end.  Pre-tokens of one content are looked up once."""
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
    raw = data.tobytes()
    offsets = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a code point
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    texts = np.searchsorted(offsets, bounds)
    starts = offsets[boundaries(points, texts[:-1][texts[:-1] < len(points)])]
    sizes = np.diff(np.r_[starts, len(data)])
    short = np.flatnonzero(sizes <= 16)
    long = np.flatnonzero(sizes > 16)
    one, which = _alike(data, starts[short], sizes[short])
    chosen = np.r_[short[one], long]
    kinds = np.empty(len(starts), np.int64)
    kinds[short] = which
    kinds[long] = len(one) + np.arange(len(long))
    found = vocab.ids_of([raw[i:i + n] for i, n in zip(starts[chosen].tolist(), sizes[chosen].tolist())])
    counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), np.int32)
    ids, places = _gathered(flat, (np.cumsum(counts) - counts)[kinds], counts[kinds])
    return ids, places[np.searchsorted(starts, bounds)]


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """Every row's token ids, their decoding, and the byte offset at which each token starts.

    A null or empty text has no token.  Nothing is special: the string of a special token is text.  Texts are
    encoded whole, in one pass without a shuffle; repeated rows and null keys stay as they are.

    :param path: the rank file, readable on every executor.
    :param ids: also return ``ids`` and ``offsets`` (int arrays) and ``decoded`` (binary).
    :returns: ``(key, n_tokens, ids_sha256, decoded_sha256)``: digests of the ids in decimal, joined by a space, and of
        the bytes decoded from the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for whole in batches:
            for batch in pieces(whole, "text"):
                flat, bounds = encoded(batch.column(1), vocab)
                decoded, places = vocab.decode(flat)
                rows = {name: [] for name in columns}
                for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
                    i, j = places[a], places[b]
                    back = decoded[i:j].tobytes()
                    names = " ".join(map(vocab.names.__getitem__, flat[a:b].tolist()))
                    rows["n_tokens"].append(b - a)
                    rows["ids_sha256"].append(hashlib.sha256(names.encode()).hexdigest())
                    rows["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
                    if ids:
                        rows["ids"].append(flat[a:b])
                        rows["offsets"].append((places[a:b] - i).astype(np.int32))
                        rows["decoded"].append(back)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(rows[name], kind) for name, kind in columns.items()]], ["key", *columns])

    columns = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    schema = "key long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if ids:
        columns |= {"ids": pa.list_(pa.int32()), "offsets": pa.list_(pa.int32()), "decoded": pa.binary()}
        schema += ", ids array<int>, offsets array<int>, decoded binary"
    return df.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
