"""Spelling variants: words one edit apart, found in a trie of letter counts with a budget of one surplus and one deficit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import per_process, stored, utf8

#: Letter groups, by the code point's remainder; a word's vector has their counts.
GROUPS = 16
#: Words below a node of the trie that are searched together, and at most so many such nodes' worth of inner nodes.
SHARD, NODES = 8192, 1 << 16
#: Searches that one task makes in a shard; a shard that more words ask is kept several times.
ASKED = 1 << 15
#: Nodes that a search holds at a time on one level, and pairs that are verified together.
FRONTIER, PAIRS = 1 << 16, 1 << 16
#: Levels of the trie whose nodes are counted in one job.
DEPTHS = 4
#: Code points of words that are compared side by side; longer ones are compared one by one.
WIDE = 64
ROUTED = "shard long, asks boolean, word string, n long"
FOUND = "word string, near long, most long, best string"


def corpus_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """How often each word of at least ``letters`` code points stands in the texts, if ``least`` times or more.

    Words are runs of ``A-Za-z`` and of U+00C0 to U+00FF, of which only A-Z become small.  Where ``every`` divides the CRC-32 of
    key, colon and word, the word loses the code point at that CRC modulo its length: planted slips.
    """
    small = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = F.regexp_extract_all(small, F.lit(f"([a-zÀ-ÿ]{{{letters},}})"), F.lit(1))  # shorter ones only get shorter
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    words = df.select(key.alias("key"), F.explode(runs).alias("run"))
    words = words.select("run", F.crc32(F.encode(F.concat_ws(":", "key", "run"), "UTF-8")).alias("crc"))
    at = (F.col("crc") % F.char_length("run")).cast("int")
    slip = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = words.select(F.when(F.col("crc") % every == 0, slip).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


# -- words as arrays


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a column's words end to end, and the bounds of the words there."""
    data, bounds = utf8(column)
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)
    return points, np.searchsorted(leads, bounds)


def _outlines(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each word its first two and last two code points, a set of its letters by remainder, and its length."""
    starts, sizes = bounds[:-1], np.diff(bounds)
    long = sizes > 1
    heads, tails, letters = np.zeros((3, len(sizes)), np.int64)
    at, stop = starts[long], bounds[1:][long]
    heads[long], tails[long] = points[at] << 21 | points[at + 1], points[stop - 2] << 21 | points[stop - 1]
    some = sizes > 0
    if some.any():
        letters[some] = np.bitwise_or.reduceat(np.int64(1) << points % 64, starts[some])
    return heads, tails, letters, sizes


def _possible(x: tuple[np.ndarray, ...], a: np.ndarray, y: tuple[np.ndarray, ...], b: np.ndarray) -> np.ndarray:
    """The pairs that one edit may part: two code points or more are common at the start or at the end, unless a word has fewer
    than four, and at most two letters are in one word only."""
    ends = (x[0][a] == y[0][b]) | (x[1][a] == y[1][b]) | (np.minimum(x[3][a], y[3][b]) < 4)
    return np.flatnonzero(ends & (np.bitwise_count(x[2][a] ^ y[2][b]) <= 2))


def _vectors(points: np.ndarray, bounds: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each word how many of its letters each group has, the groups in the order of the trie's levels."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    return np.bincount(row * GROUPS + points % GROUPS, minlength=n * GROUPS).reshape(n, GROUPS)[:, order]


def _child(node: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The number of the node below ``node`` that ``count`` letters of the next group lead to."""
    x = node ^ (count.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _has(inner: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    if not len(inner):
        return np.zeros(len(nodes), bool)
    return inner[np.minimum(np.searchsorted(inner, nodes), len(inner) - 1)] == nodes


# -- the upper part of the trie: which words are searched together


def _level_order(words: DataFrame) -> np.ndarray:
    """The groups by how much their counts vary: those that part the words best come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _vectors(*_points(batch.column(0)), np.arange(GROUPS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(GROUPS)), pa.array(counts.sum(axis=0)), pa.array((counts ** 2).sum(axis=0)), pa.array([len(counts)] * GROUPS)],
                ["group", "total", "squares", "words"])

    sums = words.select("word").mapInArrow(run, "group long, total long, squares long, words long").groupBy("group").agg(
        F.sum("total"), F.sum("squares"), F.sum("words")).collect()  # a row for each group
    spread = {r[0]: r[2] / r[3] - (r[1] / r[3]) ** 2 for r in sums if r[3]}
    return np.array(sorted(range(GROUPS), key=lambda g: (-spread.get(g, 0.0), g)))


def _inner_nodes(words: DataFrame, order: np.ndarray, most: int) -> tuple[np.ndarray, dict[int, int]]:
    """The nodes that more than ``most`` words lie below, and for such leaves the number of their words.

    On each level there are at most as many as ``most`` goes into all words, so the driver can hold them.
    """
    inner, crowds = np.zeros(0, np.uint64), {}
    for top in range(0, GROUPS + 1, DEPTHS):
        held = inner

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts = _vectors(*_points(batch.column(0)), order)
                node, below = np.zeros(len(counts), np.uint64), np.ones(len(counts), bool)
                for depth in range(min(top + DEPTHS, GROUPS + 1)):
                    if depth:
                        node = _child(node, counts[:, depth - 1])
                    if depth < top:
                        below &= _has(held, node)
                        continue
                    one, size = np.unique(node[below], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(one), depth)), pa.array(one.view(np.int64)), pa.array(size)], ["depth", "node", "size"])

        sizes = words.select("word").mapInArrow(run, "depth long, node long, size long").groupBy("depth", "node").agg(F.sum("size").alias("size"))
        rows = sizes.where(F.col("size") > most).collect()
        found = np.array([r["node"] for r in rows if r["depth"] < GROUPS], np.int64).view(np.uint64)
        crowds.update({r["node"]: r["size"] for r in rows if r["depth"] == GROUPS})
        inner = np.union1d(inner, found)
        if not any(r["depth"] == min(top + DEPTHS, GROUPS + 1) - 1 for r in rows):
            break
    return inner, crowds


def _leaves(counts: np.ndarray, inner: np.ndarray, near: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each word its shard, the first node on its way that is not inner; or with ``near`` all shards that a budget of
    one surplus and one deficit reaches.  Gives rows and nodes."""
    rows, nodes = [], []
    row = np.arange(len(counts))
    node, more, less = np.zeros(len(row), np.uint64), np.full(len(row), near), np.full(len(row), near)
    for depth in range(GROUPS + 1):
        stays = _has(inner, node) if depth < GROUPS else np.zeros(len(row), bool)
        rows.append(row[~stays])
        nodes.append(node[~stays])
        row, node, more, less = row[stays], node[stays], more[stays], less[stays]
        if not len(row):
            break
        own = counts[row, depth]
        row, node, count, more, less = _spent(row, node, own, more, less)
        node = _child(node, count)
    row, node = np.concatenate(rows), np.concatenate(nodes)
    if near:  # two ways may lead to one number
        both = np.unique(np.rec.fromarrays([row, node]))
        row, node = both.f0, both.f1
    return row, node


def _spent(row, node, own, more, less):
    """All ways to go on from each node: the word's own count, one more if the surplus is left, one less if the deficit is."""
    up, down = np.flatnonzero(more), np.flatnonzero(less & (own > 0))
    at = np.concatenate((np.arange(len(row)), up, down))
    count = np.concatenate((own, own[up] + 1, own[down] - 1))
    still_more, still_less = more[at], less[at]
    still_more[len(row):len(row) + len(up)] = False
    still_less[len(row) + len(up):] = False
    return row[at], node[at], count, still_more, still_less


def _routed(words: DataFrame, order: np.ndarray, inner: np.ndarray, crowds: dict[int, int], most: int) -> DataFrame:
    """Every word once in its shard, and once for each shard that it has to ask.

    A leaf of more than ``most`` words is dealt out into blocks by a hash, and whoever asks it asks all of them.
    """
    hot = np.array(sorted(crowds), np.int64).view(np.uint64)
    hot.sort()
    blocks = np.array([-(-crowds[int(k)] // most) for k in hot.view(np.int64)], np.int64)

    def dealt(row: np.ndarray, node: np.ndarray, salt: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        crowd = _has(hot, node)
        if not crowd.any():
            return row, node
        parts = blocks[np.searchsorted(hot, node[crowd])]
        if salt is not None:
            node[crowd] = _child(node[crowd], salt[row[crowd]] % parts)
            return row, node
        ends = np.cumsum(parts)
        block = np.arange(ends[-1]) - np.repeat(ends - parts, parts)
        return np.r_[row[~crowd], np.repeat(row[crowd], parts)], np.r_[node[~crowd], _child(np.repeat(node[crowd], parts), block)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_process("spelling", bool)  # what other operators keep goes
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                counts = _vectors(*_points(batch.column(0)), order)
                for asks in (False, True):
                    row, node = _leaves(counts, inner, asks)
                    row, node = dealt(row, node, None if asks else batch.column(2).to_numpy())
                    rows = pa.array(row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node.view(np.int64)), pa.array(np.full(len(row), asks)), batch.column(0).take(rows), batch.column(1).take(rows)],
                        ["shard", "asks", "word", "n"])

    return words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 30)).alias("salt")).mapInArrow(run, ROUTED)


# -- the lower part: a search within a shard


class _Shard:
    """The trie of a shard's words.  Words are numbered by preference: the more frequent first, then by code points."""

    def __init__(self, words: list[bytes], n: np.ndarray, order: np.ndarray):
        first = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
        self.words, self.n = [words[i] for i in first], n[first]
        self.points, self.bounds = _points(pa.array(self.words, pa.binary()))
        self.outlines = _outlines(self.points, self.bounds)
        counts = _vectors(self.points, self.bounds, order)
        self.base = int(counts.max(initial=0)) + 2
        self.sorted = np.lexsort(counts.T[::-1])
        rows, node, new = counts[self.sorted], np.zeros(len(first), np.int64), np.zeros(len(first), bool)
        self.keys, previous = [], node
        for depth in range(GROUPS):  # the children of a level's nodes, by node and count
            key = previous * self.base + rows[:, depth]
            new[1:] |= rows[1:, depth] != rows[:-1, depth]
            node = np.cumsum(new)
            self.keys.append(key[np.r_[True, new[1:]]])
            previous = node
        self.starts = np.r_[np.flatnonzero(np.r_[True, new[1:]]), len(first)]

    def search(self, points: np.ndarray, bounds: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word that asks: how many words are one edit away, and the number of the first of them (or that of all)."""
        counts, outlines = _vectors(points, bounds, order), _outlines(points, bounds)
        n = len(counts)
        near, best = np.zeros(n, np.int64), np.full(n, len(self.words), np.int64)
        row = np.arange(n)
        stack = [(0, row, np.zeros(n, np.int64), np.ones(n, bool), np.ones(n, bool))]
        while stack:  # depth first, many searches side by side; what is too much at once waits on the stack
            depth, row, node, more, less = stack.pop()
            if depth == GROUPS:
                self._verify(points, bounds, outlines, row, node, near, best)
                continue
            if len(row) > FRONTIER:
                stack.append((depth, *(x[FRONTIER:] for x in (row, node, more, less))))
                row, node, more, less = (x[:FRONTIER] for x in (row, node, more, less))
            row, node, count, more, less = _spent(row, node, counts[row, depth], more, less)
            keys, wanted = self.keys[depth], node * self.base + count
            child = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            there = np.flatnonzero((keys[child] == wanted) & (count < self.base))
            if len(there):
                stack.append((depth + 1, row[there], child[there], more[there], less[there]))
        return near, best

    def _verify(self, points, bounds, outlines, row, leaf, near, best) -> None:
        sizes = self.starts[leaf + 1] - self.starts[leaf]
        ends = np.cumsum(sizes)
        cuts = np.searchsorted(ends, np.arange(PAIRS, ends[-1] + PAIRS, PAIRS), "left")  # leaves of about so many pairs together
        for i, j in zip([0, *(cuts + 1).tolist()], [*(cuts + 1).tolist(), len(leaf)]):
            if i >= j:
                continue
            n, first = sizes[i:j], self.starts[leaf[i:j]]
            asks = np.repeat(row[i:j], n)
            word = self.sorted[np.arange(len(asks)) + np.repeat(first - (np.cumsum(n) - n), n)]
            some = _possible(outlines, asks, self.outlines, word)
            asks, word = asks[some], word[some]
            good = one_edit(points, bounds, asks, self.points, self.bounds, word)
            np.add.at(near, asks[good], 1)
            np.minimum.at(best, asks[good], word[good])


def _padded(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int, backwards: bool) -> np.ndarray:
    """The first (or last) code points of words as rows of one width."""
    step = np.arange(width)
    at = starts[:, None] + (sizes[:, None] - 1 - step if backwards else step)
    inside = step < sizes[:, None]
    return np.where(inside, points[np.clip(at, 0, len(points) - 1)], -1)


def one_edit(a_points, a_bounds, a, b_points, b_bounds, b) -> np.ndarray:
    """Whether the words ``a`` and ``b``, given by number, differ by one code point inserted, deleted or replaced.

    They do if they differ and what they have in common at the start and at the end is all of the longer one but one.
    """
    a_starts, b_starts = a_bounds[a], b_bounds[b]
    a_sizes, b_sizes = a_bounds[a + 1] - a_starts, b_bounds[b + 1] - b_starts
    longer = np.maximum(a_sizes, b_sizes)
    out = np.zeros(len(a), bool)
    close = np.abs(a_sizes - b_sizes) <= 1
    for i in np.flatnonzero(close & (longer > WIDE)):
        x, y = a_points[a_starts[i]:][:a_sizes[i]], b_points[b_starts[i]:][:b_sizes[i]]
        least = min(len(x), len(y))
        head, tail = (np.r_[np.flatnonzero(p[:least] != q[:least]), least][0] for p, q in ((x, y), (x[::-1], y[::-1])))
        out[i] = head + tail >= longer[i] - 1 and (len(x) != len(y) or head < least)
    some = np.flatnonzero(close & (longer <= WIDE))
    if len(some):
        width = int(longer[some].max())
        args = ((a_points, a_starts[some], a_sizes[some]), (b_points, b_starts[some], b_sizes[some]))
        heads, tails = (_first_difference(*(_padded(*w, width, back) for w in args)) for back in (False, True))
        least = np.minimum(a_sizes, b_sizes)[some]
        heads, tails = np.minimum(heads, least), np.minimum(tails, least)
        out[some] = (heads + tails >= longer[some] - 1) & ((a_sizes != b_sizes)[some] | (heads < least))
    return out


def _first_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    differ = x != y
    return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])


def _searched(batches: Iterator[pa.RecordBatch], order: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows in the order of shards, a shard's own words before those that ask."""
    shard, words, counts, built = None, [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (asks[1:] != asks[:-1]), True])
        for i, j in zip(edges.tolist(), edges[1:].tolist()):
            if ids[i] != shard:
                shard, words, counts, built = ids[i], [], [], None
            part = batch.slice(i, j - i)
            if not asks[i]:
                words += part.column(2).cast(pa.binary()).to_pylist()
                counts.append(part.column(3).to_numpy())
                continue
            if not words:
                continue
            built = built or _Shard(words, np.concatenate(counts), order)
            for k in range(0, j - i, 1 << 14):
                asking = part.column(2).slice(k, 1 << 14)
                near, best = built.search(*_points(asking), order)
                hit = np.flatnonzero(near)
                yield pa.RecordBatch.from_arrays([
                    asking.take(pa.array(hit)), pa.array(near[hit]), pa.array(built.n[best[hit]]),
                    pa.array([built.words[x].decode() for x in best[hit].tolist()], pa.string())], ["word", "near", "most", "best"])


def near_words(words: DataFrame, shard: int = SHARD, asked: int = ASKED) -> DataFrame:
    """For each word of ``(word, n)`` how many others are one edit away, and the most frequent of these.

    Words are arranged by how many letters of each group they have, one group a level.  An edit adds at most one letter to
    one group and takes at most one from one, so a search goes down with a budget of one surplus and one deficit, and the
    words of the leaves that it reaches are verified.  The trie is cut into shards where at most ``shard`` words lie below a
    node; words with all counts alike may be more and are dealt out.  A shard that many ask is kept several times.
    Nothing is emitted for a pair: each shard gives a count and its best word for each word that asks it.

    :returns: ``(word, n_near, form_n, best)``, no row for words without a near one.
    """
    order = _level_order(words)
    most = max(shard, words.count() // NODES)
    inner, crowds = _inner_nodes(words, order, most)
    routed, drop_routed = stored(_routed(words, order, inner, crowds, most), "routed")
    sizes = routed.groupBy("shard").agg(F.count_if("asks").alias("asking"), F.count_if(~F.col("asks")).alias("own"))
    sizes = sizes.where("own > 0 and asking > 0").select("shard", F.ceil(F.col("asking") / asked).cast("int").alias("copies"))
    own = F.pmod(F.xxhash64("word"), F.col("copies")).cast("int")
    copies = F.when(F.col("asks"), F.array(own)).otherwise(F.sequence(F.lit(0), F.col("copies") - 1))
    dealt = routed.join(sizes, "shard").withColumn("copy", F.explode(copies))
    dealt = dealt.select(F.when(F.col("copies") == 1, F.col("shard")).otherwise(F.xxhash64("shard", "copy")).alias("shard"), "asks", "word", "n")
    together = dealt.repartition("shard").sortWithinPartitions("shard", "asks")
    found, drop_found = stored(together.mapInArrow(lambda b: _searched(b, order), FOUND), "near")
    first = F.min(F.struct((-F.col("most")).alias("less"), F.col("best").alias("word")))
    rows = found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("first"))
    out, _ = stored(rows.select("word", "n_near", (-F.col("first.less")).alias("form_n"), F.col("first.word").alias("best")), "nearest")
    drop_routed()
    drop_found()
    return out


def _roots(forms: DataFrame) -> DataFrame:
    """The last form that each word's chain of forms leads to: ``(word, root)`` for words that have a form.

    A form has twice the count of its word or more, so that a chain is shorter than a count has bits: six doublings
    of the steps follow any chain.
    """
    now, drop = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(6):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = now.join(ahead.hint("merge"), "root", "left")
        if joined.where("further is not null").isEmpty():
            break
        now_after, drop_after = stored(joined.select("word", F.coalesce("further", "root").alias("root")), "roots")
        drop()
        now, drop = now_after, drop_after
    return now


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = 5, least: int = 3, times: int = 2,
             every: int = 97, shard: int = SHARD, asked: int = ASKED) -> DataFrame:
    """Words of the texts, grouped by spelling: each with the frequent word one edit away that it is a variant of.

    A word's form is, of the words one code point away, the one that occurs most (of equals the first by code points), if that is
    ``times`` as often or more; its root is where forms lead in the end.  A null or empty text has no word, and repeated rows
    count again; a null key counts as an empty one.  Texts and words of any length are taken whole.  No text gives no row.

    :returns: ``(word, n, n_near, form, form_n, root)``.
    """
    words, _ = stored(corpus_words(df, id_col, text_col, letters, least, every), "words")
    near = near_words(words, shard, asked)
    is_form = F.col("form_n") >= times * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    rows, _ = stored(joined, "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
