"""Token counts without ids: pairs merge in a linked list in the order of a heap, and merges are counted."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordinate.llm.bpe import _alike, boundaries
from ordinate.llm.common import per_process, pieces, utf8

#: Pre-tokens whose counts a process keeps, and the longest one that it keeps, in bytes.
KEPT = 1 << 20
KEPT_BYTES = 64


def _byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself, or the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Merges:
    """The merges of a byte-level vocabulary in order, and its strings that are tokens wherever they stand."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, split = whole["model"], whole["pre_tokenizer"]
        plain = {k: v for k, v in split.items() if k in ("type", "add_prefix_space", "use_regex")}
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        strings = [t["content"] for t in whole["added_tokens"]]
        odd += [t["content"] for t in whole["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if odd or whole["normalizer"] or model["type"] != "BPE" or plain != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            raise ValueError(f"{path} is not a plain byte-level vocabulary: {odd}")
        longest = sorted(strings, key=len, reverse=True)
        self.special = regex.compile(b"|".join(regex.escape(s.encode()) for s in longest)) if longest else None
        names, vocab = _byte_names(), model["vocab"]
        self.symbols = [0] * 256
        for name, byte in names.items():
            self.symbols[byte] = vocab[name]
        pairs = (pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"])
        self.pairs = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.kept: dict[bytes, int] = {}

    def count(self, piece: bytes) -> int:
        """The symbols of a pre-token less its merges: the adjacent pair of lowest rank merges, the leftmost first."""
        pairs, held = self.pairs, [self.symbols[b] for b in piece]
        n = len(held)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*found, i) for i in range(n - 1) if (found := pairs.get((held[i], held[i + 1]))) is not None]
        heap = [(rank, i, made) for rank, made, i in heap]
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if held[i] is None or j >= n or pairs.get((held[i], held[j]), (-1,))[0] != rank:
                continue  # a neighbour has merged since
            held[i], held[j] = made, None
            merges += 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := pairs.get((made, held[k]))) is not None:
                    heapq.heappush(heap, (found[0], i, found[1]))
            if (h := before[i]) >= 0 and (found := pairs.get((held[h], made))) is not None:
                heapq.heappush(heap, (found[0], h, found[1]))
        return n - merges

    def counts(self, found: list[bytes]) -> list[int]:
        """Counts of different pre-tokens, from those kept as far as they are."""
        out, kept = list(map(self.kept.get, found)), self.kept
        for i, known in enumerate(out):
            if known is None:
                out[i] = self.count(found[i])
                if len(found[i]) <= KEPT_BYTES:
                    if len(kept) >= KEPT:
                        kept.clear()
                    kept[found[i]] = out[i]
        return out


def _special(raw: bytes, bounds: np.ndarray, pattern) -> np.ndarray:
    """Starts and ends of strings that are tokens by themselves, none of them across two texts."""
    found = []
    if pattern is not None and pattern.search(raw):
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            found += [m.span() for m in pattern.finditer(raw, a, b)]
    return np.array(found, np.int64).reshape(-1, 2)


def counted(column: pa.Array, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text of a column."""
    data, bounds = utf8(column)
    if not len(data):
        return np.diff(bounds), np.zeros(len(bounds) - 1, np.int64)
    raw = data.tobytes()
    special = _special(raw, bounds, merges.special)
    edges = np.unique(np.r_[bounds, special.ravel()])
    leads = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a code point
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    cuts = np.searchsorted(leads, edges)
    starts = leads[boundaries(points, cuts[cuts < len(points)])]
    sizes = np.diff(np.r_[starts, len(data)])
    short, long = np.flatnonzero(sizes <= 16), np.flatnonzero(sizes > 16)
    one, which = _alike(data, starts[short], sizes[short])
    chosen = np.r_[short[one], long]
    found = merges.counts([raw[i:i + n] for i, n in zip(starts[chosen].tolist(), sizes[chosen].tolist())])
    tokens = np.zeros(len(starts), np.int64)
    tokens[short] = np.array(found[:len(one)], np.int64)[which]
    tokens[long] = found[len(one):]
    for a, b in special.tolist():
        i, j = np.searchsorted(starts, (a, b))
        tokens[i:j] = 0
        tokens[i] = 1
    total = np.r_[0, np.cumsum(tokens)]
    return np.diff(bounds), np.diff(total[np.searchsorted(starts, bounds)])


def count_tokens(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """How many tokens each text has, and whether that is more than ``limit``.

    Every pre-token starts as its bytes; pairs merge by rank, and the count is what is left.  Pre-tokens of one content are
    counted once, and a process keeps the counts of short ones.  Strings of special tokens count as one token, as the
    vocabulary's library has it.  A null or empty text has no token.  Texts are counted whole, in one pass without a
    shuffle; a text larger than a piece is a piece of its own.  Rows that repeat and null keys stay as they are.

    :param path: the vocabulary file (JSON with merges), readable on every executor.
    :returns: ``(key, n_bytes, n_tokens, over_limit)``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = per_process(f"counts {path}", lambda: Merges(path))
        for whole in batches:
            for batch in pieces(whole, "text"):
                size, tokens = counted(batch.column(1), merges)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size), pa.array(tokens), pa.array(tokens > limit)], ["key", "n_bytes", "n_tokens", "over_limit"])

    rows = df.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "key long, n_bytes long, n_tokens long, over_limit boolean")
