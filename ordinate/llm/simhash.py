"""Near-duplicate texts by SimHash: fingerprints that differ in few bits meet in a block."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import per_process, release, stored, utf8
from ordinate.llm.components import components

BITS = 64
SEED = 42
#: Blocks of a fingerprint beyond the bits that may differ: each pair shares so many blocks at least.
SHARED = 3
#: Rows of a block that are compared with each other; larger blocks are split by further bits.
BLOCK_ROWS = 4096
#: Shingles that are held at a time.
HELD = 1 << 16

FINGERPRINTS = "key long, fingerprint long"
FOUND = "a long, b long, mask long"


def fingerprint(text: bytes, size: int) -> int:
    """The SimHash of a text's word shingles; zero if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < size:
        words, size = [b" ".join(words)], 1
    total = max(len(words) - size + 1, 0)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, total, HELD):
        part = words[at:at + HELD + size - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(size)))) if size > 1 else part
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(key, fingerprint)`` of every row, in one pass over the texts without a shuffle.

    Words are runs of anything but ASCII white space, with A-Z lowered.  Texts of fewer words than a
    shingle count as one shingle; null, empty and blank texts have fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            values = np.fromiter(
                (fingerprint(data[i:j].tobytes(), shingle) for i, j in zip(bounds, bounds[1:])), np.int64, len(bounds) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["key", "fingerprint"])

    return df.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FINGERPRINTS)


def _cut(mask: int, parts: int) -> list[int]:
    """The bits of a mask in so many runs of nearly equal length."""
    places = [i for i in range(BITS) if mask >> i & 1]
    return [sum(1 << int(i) for i in run) for run in np.array_split(places, parts) if len(run)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(distance: int) -> list[int]:
    """Which bits must be equal: any two fingerprints within the distance agree under one mask at least."""
    blocks = _cut((1 << BITS) - 1, distance + SHARED)
    return [_signed(sum(chosen)) for chosen in combinations(blocks, SHARED)]


def _narrower(mask: int, distance: int) -> list[int]:
    """Masks with more bits: two fingerprints within the distance that agree under the mask agree under one of these."""
    mask &= (1 << BITS) - 1
    return [_signed(mask | more) for more in _cut(~mask & (1 << BITS) - 1, distance + 1)]


def _forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what links within the distance connect: at most one for each value."""
    links, rest = [], values
    while len(rest):
        root, front, rest = int(rest[0]), [rest[0]], rest[1:]
        while front and len(rest):
            near = np.bitwise_count((rest ^ front.pop()).view(np.uint64)) <= distance
            if near.any():
                front.extend(rest[near])
                links.extend((root, int(v)) for v in rest[near])
                rest = rest[~near]
    return links


def _compared(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(mask, fingerprint, block)`` in the order of their blocks: links, or rows for narrower masks."""

    def out(a, b, mask):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(mask, pa.int64())], ["a", "b", "mask"])

    def deferred(mask: int, values: np.ndarray):
        for narrow in _narrower(mask, distance):
            yield out(values, pa.nulls(len(values), pa.int64()), np.full(len(values), narrow))

    def settle(held: list, block, wide: bool):
        mask, values = block[0], np.unique(np.concatenate(held))
        if not wide and len(values) <= BLOCK_ROWS:
            links = _forest(values, distance)
            if links:
                a, b = zip(*links)
                yield out(a, b, pa.nulls(len(a), pa.int64()))
        else:
            yield from deferred(mask, values)

    block, held, rows, wide = None, [], 0, False
    for batch in batches:
        masks, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keys = values & masks
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (masks[1:] != masks[:-1])])
        ends = np.r_[starts[1:], len(values)]
        last = len(starts) - 1
        alone = ends - starts == 1
        for n in np.flatnonzero(~alone | (np.arange(last + 1) == 0) | (np.arange(last + 1) == last)):
            i, j = int(starts[n]), int(ends[n])
            now = (int(masks[i]), int(keys[i]))
            if block != now:
                if rows > 1:
                    yield from settle(held, block, wide)
                block, held, rows, wide = now, [], 0, False
            held.append(values[i:j])
            rows += j - i
            if sum(map(len, held)) > 2 * BLOCK_ROWS:
                few = np.unique(np.concatenate(held))
                if wide or len(few) > BLOCK_ROWS:
                    yield from deferred(now[0], few)
                    wide, few = True, few[:0]
                held = [few]
    if rows > 1:
        yield from settle(held, block, wide)


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """For different fingerprints: links ``(a, b)`` that connect just those that chains within the distance connect.

    Pigeonhole: fingerprints cut into ``distance + 3`` blocks share three of them, so each is dealt out once
    for every choice of three, and only those that agree there are compared.  A block of more than
    ``BLOCK_ROWS`` is dealt out again by further bits, which keeps every task's work bounded.
    """
    rows = distinct.select("fingerprint", F.explode(F.array(*[F.lit(m).cast("long") for m in block_masks(distance)])).alias("mask"))
    found = None
    while True:
        ordered = (
            rows.select("mask", "fingerprint", F.xxhash64("mask", F.col("fingerprint").bitwiseAND(F.col("mask"))).alias("block"))
            .repartition("block").sortWithinPartitions("block", "mask", F.col("fingerprint").bitwiseAND(F.col("mask"))).drop("block")
        )
        step, _ = stored(ordered.mapInArrow(lambda batches: _compared(batches, distance), FOUND), "blocks")
        near = step.where("b is not null").select("a", "b")
        found = near if found is None else found.unionByName(near)
        rows = step.where("b is null").select(F.col("a").alias("fingerprint"), "mask").distinct()
        if rows.isEmpty():
            return found


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """Every row's key, SimHash and component.

    Texts whose fingerprints differ in at most ``distance`` bits are linked; a component is what links
    reach, named by its smallest key.  Copies meet as one fingerprint before any comparison, so that a
    group of copies costs one row.  Rows with a null key keep their fingerprint and link others; their
    component is the smallest key that is not null, or null if there is none.  Repeated rows stay.
    Columns other than the two named are not read.

    :returns: ``(key, fingerprint, component)``.
    """
    prints, _ = stored(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    distinct, _ = stored(prints.groupBy("fingerprint").agg(F.min("key").alias("low")), "distinct")
    reached = components(links(distinct, distance))
    roots, _ = stored(
        distinct.join(reached.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .select("fingerprint", "low", F.coalesce("root", "fingerprint").alias("root")), "roots")
    lows = roots.groupBy("root").agg(F.min("low").alias("component"))
    named, _ = stored(roots.join(lows, "root").select("fingerprint", "component"), "named")
    return prints.join(named.hint("merge"), "fingerprint").select("key", "fingerprint", "component")


#: A wide fingerprint's words of 64 bits.  Bands of least hashes, and how many of these must agree for two texts to meet.
WIDE, BANDS, LEAST_HASHES = 8, 32, 6
#: Rows of a band's value that are compared with each other in one piece; more are compared part against part.
WIDE_ROWS = 8192
#: Sets of one side that are verified together, and candidates for which it pays to bring them together.
SETS, CANDIDATES = 512, 500
#: Texts of a band's value whose sets are verified against each other in one piece.
CROWD_ROWS = 2048
PRINTS = "key long, mark long, id long, fingerprint long, bits binary, bands array<long>"
PAIRS = "a long, b long"
#: Rows of a band.  Of two rows with sides only those of different sides are compared; ``alone`` is for rows without one.
BANDED = ["block", "value", "id", "root", "side", "bits"]
MET = "block int, value long, id long, root long, side int, bits binary, met boolean"
ALONE = -1
#: Odd factors that make one hash many.
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * LEAST_HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def all_hashes(text: bytes, size: int) -> np.ndarray:
    """The hashes of a text's word shingles, repeats included; empty if it has no word."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        words, size = [b" ".join(words)], 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(size)))) if size > 1 else words
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """The set of a text's word shingles as sorted hashes; empty if it has no word."""
    return np.unique(all_hashes(text, size))


def print_of(hashes: np.ndarray) -> int:
    """The SimHash of a text of which these are all shingles' hashes, as :func:`fingerprint` gives it."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), HELD):
        ones += np.unpackbits(hashes[at:at + HELD].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def band_values(hashes: np.ndarray) -> np.ndarray:
    """A number for each band of least hashes: sets of similarity J agree in a band with a probability of J ** LEAST_HASHES."""
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        mixed = hashes[at:at + 1024]
        mixed = mixed ^ (mixed >> np.uint64(29))
        least = np.minimum(least, (FACTORS[:, None] * mixed[None, :]).min(axis=1))
    rows = least.reshape(BANDS, LEAST_HASHES)
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), SEED) for row in rows], np.uint64).view(np.int64)


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """A SimHash of ``64 * WIDE`` bits over a set of hashes; zero if it is empty."""
    if not len(hashes):
        return bytes(8 * WIDE)
    ones = np.zeros(64 * WIDE, np.int64)
    for at in range(0, len(hashes), HELD // WIDE):
        x = hashes[at:at + HELD // WIDE, None] + np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def bits_apart(least: float) -> int:
    """Bits by which wide fingerprints of candidates may differ: what sets with a Jaccard similarity of ``least`` differ by
    on average, and three standard deviations more."""
    share, bits = float(np.arccos(min(1.0, 2 * least / (1 + least))) / np.pi), 64 * WIDE
    return int(bits * share + 3 * np.sqrt(bits * share * (1 - share)))


def _bits(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(utf8(column)[0]).view(np.uint64).reshape(-1, WIDE)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)


def _starred(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order of blocks and values: candidates with the first row of a value in the batch and with the row before."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, value, ids = (batch.column(k).to_numpy() for k in range(3))
        rows = _bits(batch.column(BANDED.index("bits")))
        new = np.r_[True, (block[1:] != block[:-1]) | (value[1:] != value[:-1])]
        start = np.flatnonzero(new)[np.cumsum(new) - 1]
        at = np.flatnonzero(~new)
        i, j = np.r_[start[at], at - 1], np.r_[at, at]
        near = _apart(rows[i], rows[j]) <= distance
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(ids[i], ids[j])[near], pa.int64()), pa.array(np.maximum(ids[i], ids[j])[near], pa.int64())], ["a", "b"])


def _members_of(table: pa.Table, distance: int) -> Iterator[pa.RecordBatch]:
    """The rows that have another of their block and value whose fingerprint is near and whose root differs: each once, no pairs."""
    block, value, root, side = (table.column(name).to_numpy() for name in ("block", "value", "root", "side"))
    rows = _bits(table.column("bits").combine_chunks())
    starts = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (value[1:] != value[:-1])])
    sizes = np.diff(np.r_[starts, len(rows)])
    group = np.repeat(np.arange(len(starts)), sizes)
    met = np.zeros(len(rows), bool)
    for lag in range(1, min(64, int(sizes.max(initial=1)))):
        i = np.flatnonzero((group[lag:] == group[:-lag]) & (root[lag:] != root[:-lag]) & _meet(side[lag:], side[:-lag]))
        i = i[_apart(rows[i], rows[i + lag]) <= distance]
        met[i] = met[i + lag] = True
    for g in np.flatnonzero(sizes > 64):
        end = starts[g] + sizes[g]
        for i in range(starts[g], end - 64):
            j = np.flatnonzero((root[i + 64:end] != root[i]) & _meet(side[i + 64:end], side[i])) + i + 64
            j = j[_apart(rows[j], rows[i]) <= distance]
            met[j] = True
            met[i] |= len(j) > 0
    if met.any():
        yield _flagged(table.filter(pa.array(met)), True)


def _meet(one, two):
    return (one == ALONE) | (one != two)


def _flagged(table: pa.Table, met: bool) -> pa.RecordBatch:
    columns = [table.column(name).combine_chunks() for name in BANDED]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(table.num_rows, met))], [*BANDED, "met"])


def _wide_compared(batches: Iterator[pa.RecordBatch], distance: int, narrow: bool) -> Iterator[pa.RecordBatch]:
    """Rows in the order of blocks and values: those that met others, or all rows of a large value, which wait."""
    held, wide = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        block, value = table.column("block").to_numpy(), table.column("value").to_numpy()
        last = (block == block[-1]) & (value == value[-1])
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        mark = (int(block[-1]), int(value[-1]))
        if cut:
            head = table.slice(0, cut)
            if wide is not None:  # the rest of a value whose rows were put off
                own = int(((block[:cut] == wide[0]) & (value[:cut] == wide[1])).sum())
                if own:
                    yield _flagged(head.slice(0, own), False)
                head, wide = head.slice(own), None
            if head.num_rows:
                yield from _members_of(head, distance)
        held = table.slice(cut)
        if narrow and (held.num_rows > WIDE_ROWS or wide == mark):
            yield _flagged(held, False)
            held, wide = None, mark
    if held is not None and held.num_rows:
        if wide is not None and wide == (held.column("block")[0].as_py(), held.column("value")[0].as_py()):
            yield _flagged(held, False)
        else:
            yield from _members_of(held, distance)


def _in_parts(rows: DataFrame, most: int, side: str) -> DataFrame:
    """The rows of large values dealt out so that any two of a value meet once, in pieces of about ``most``.

    A piece holds two parts, whose rows get different sides, or one part against itself.
    """
    sizes, _ = stored(rows.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")), "large")
    parts = F.ceil(2 * F.col("n") / most).cast("int")
    own = F.pmod(F.xxhash64("id", F.lit(side)), parts).cast("int")
    dealt = rows.join(sizes.hint("merge"), ["block", "value"]).withColumn(
        "own", F.when(F.col("n") <= most, 0).otherwise(own)).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.when(F.col("n") <= most, 0).otherwise(parts - 1))))
    piece = F.when(F.col("n") <= most, F.col("value")).otherwise(F.xxhash64("value", F.least("own", "other"), F.greatest("own", "other")))
    sided = F.when(F.col("own") == F.col("other"), ALONE).otherwise((F.col("own") > F.col("other")).cast("int"))
    return dealt.withColumn("value", piece).withColumn(side, sided).drop("n", "own", "other")


def _sets_of(ids: DataFrame, distinct: DataFrame, docs: DataFrame, shingle: int) -> tuple[DataFrame, Callable[[], None]]:
    """``(id, hashes)``: sets of shingles, made again from the texts.  Kept for all, they would be larger than the texts."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_process("simhash", bool)
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            sets = [shingle_hashes(data[i:j].tobytes(), shingle).tobytes() for i, j in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "hashes"])

    chosen = distinct.select("id", "first.key", "first.mark").join(ids.select("id").distinct(), "id", "left_semi")
    texts = docs.join(chosen.hint("merge"), docs["mark"].eqNullSafe(chosen["mark"]) & docs["key"].eqNullSafe(chosen["key"])).select("id", "text")
    return stored(texts.mapInArrow(shingled, "id long, hashes binary").dropDuplicates(["id"]), "sets")


def _alike(one: np.ndarray, two: np.ndarray, least: float) -> bool:
    if min(len(one), len(two)) < least * max(len(one), len(two)):
        return False
    common = len(np.intersect1d(one, two, assume_unique=True))
    return common >= least * (len(one) + len(two) - common)


def _crowd_links(table: pa.Table, distance: int, least: float) -> pa.Table:
    """Links that connect the texts of one block and value that verified pairs connect: fewer than there are texts.

    Two texts are compared in the first band that they share, if their fingerprints are near and nothing connects them yet.
    """
    ids, roots, side, part = (table.column(name).to_numpy() for name in ("id", "root", "side", "part"))
    block, rows = table.column("block")[0].as_py(), _bits(table.column("bits").combine_chunks())
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[:, :block]
    sets = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    group, a, b = np.unique(roots, return_inverse=True)[1], [], []
    for i in range(len(ids) - 1):
        j = np.arange(i + 1, len(ids))
        j = j[(group[j] != group[i]) & _meet(side[j], side[i]) & _meet(part[j], part[i])
              & (np.minimum(sizes[j], sizes[i]) >= least * np.maximum(sizes[j], sizes[i]))]
        j = j[_apart(rows[j], rows[i]) <= distance]
        j = j[~(bands[j] == bands[i]).any(axis=1)]
        for k in j:
            if group[k] != group[i] and _alike(sets[i], sets[k], least):
                group[group == group[k]] = group[i]
                a.append(min(ids[i], ids[k]))
                b.append(max(ids[i], ids[k]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _connected(members: DataFrame, distinct: DataFrame, docs: DataFrame, shingle: int, distance: int, least: float) -> DataFrame:
    """Links between texts that met others in a band's value; sets go to each piece of a value, and no pairs come out."""
    dealt, drop_dealt = stored(_in_parts(members, CROWD_ROWS, "part"), "crowds")
    sets, drop_sets = _sets_of(dealt, distinct, docs, shingle)
    release(docs.sparkSession)
    held = sets.join(distinct.select("id", "bands"), "id")
    links, _ = stored(dealt.join(held, "id").groupBy("block", "value").applyInArrow(lambda t: _crowd_links(t, distance, least), PAIRS), "verified")
    for drop in (drop_dealt, drop_sets):
        drop()
    release(docs.sparkSession)
    return links


def _verified(pairs: DataFrame, distinct: DataFrame, docs: DataFrame, shingle: int, n: int, least: float) -> DataFrame:
    """The candidates ``(a, b)`` whose sets have a Jaccard similarity of ``least`` or more.

    Pairs are dealt out by a part of either side; each set goes once to every two parts that need it.
    """

    def run(asked: pa.Table, sets: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, np.uint64) for x in sets.column("hashes").to_pylist()] if sets.num_rows else []
        at = {k: i for i, k in enumerate(sets.column("id").to_pylist())} if sets.num_rows else {}
        a, b = [], []
        for x, y in zip(asked.column("a").to_pylist(), asked.column("b").to_pylist()):
            if _alike(hashes[at[x]], hashes[at[y]], least):
                a.append(x)
                b.append(y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    count = pairs.count()
    parts = max(1, min(-(-n // SETS), int(np.ceil(np.sqrt(count / CANDIDATES)))))
    one, two = (F.pmod(F.xxhash64(x, F.lit("set")), F.lit(parts)) for x in ("a", "b"))
    dealt, drop_dealt = stored(pairs.withColumn("piece", F.least(one, two) * parts + F.greatest(one, two)), "candidates")
    needed, drop_needed = stored(dealt.select("piece", F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    sets, drop_sets = _sets_of(needed, distinct, docs, shingle)
    release(docs.sparkSession)
    found = dealt.groupBy("piece").cogroup(needed.join(sets, "id").groupBy("piece")).applyInArrow(run, "a long, b long")
    links, _ = stored(found, "verified")
    for drop in (drop_dealt, drop_needed, drop_sets):
        drop()
    release(docs.sparkSession)
    return links


def _met_by_print(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Candidates ``(a, b)`` that connect the texts whose SimHashes are equal or within so many bits, by the blocks of :func:`links`."""
    lows, _ = stored(prints.groupBy("fingerprint").agg(F.min("id").alias("low")), "lows")
    near, _ = stored(links(lows.select("fingerprint"), distance), "near")
    same = prints.join(lows, "fingerprint").select(F.col("low").alias("a"), F.col("id").alias("b"))
    end = lambda name: lows.select(F.col("fingerprint").alias(name), F.col("low").alias(f"low_{name}"))
    other = near.join(end("a"), "a").join(end("b"), "b").select(F.least("low_a", "low_b").alias("a"), F.greatest("low_a", "low_b").alias("b"))
    return same.unionByName(other).where("a <> b")


def similar_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: float = 0.8) -> DataFrame:
    """Groups of texts whose sets of word shingles have a Jaccard similarity of ``least`` or more, by chains.

    Texts whose SimHashes differ in at most three bits meet, as in :func:`simhash_groups`.  A similarity of ``least`` leaves more
    bits different than that, so texts that agree in one of ``BANDS`` bands of least hashes meet too, if their fingerprints of
    512 bits are near.  A link is what the sets themselves verify.  First candidates are few for each text; then
    the texts that these did not join are compared inside each value of a band, which gives connecting links, not pairs.  Values
    of more than ``WIDE_ROWS`` texts are compared part against part, so that all of theirs meet too.  Copies meet as
    one set first.  Texts without a word are alike.

    :returns: ``(key, mark, component, root)`` for each row; ``mark`` is the text's hash, ``component`` the smallest key,
        ``root`` the number of the group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_process("simhash", bool)  # what other operators keep goes
        for batch in batches:
            data, bounds = utf8(batch.column(2))
            prints, sets = [], []
            for i, j in zip(bounds, bounds[1:]):
                hashes = all_hashes(data[i:j].tobytes(), shingle)
                prints.append(print_of(hashes))
                sets.append(np.unique(hashes))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) for x in sets], pa.int64()),
                pa.array(prints, pa.int64()), pa.array([wide_fingerprint(x) for x in sets], pa.binary()), pa.array([band_values(x) for x in sets], pa.list_(pa.int64()))],
                ["key", "mark", "id", "fingerprint", "bits", "bands"])

    def banded(rows: DataFrame) -> DataFrame:
        return rows.select(F.posexplode("bands").alias("block", "value"), "id", "root", F.lit(ALONE).alias("side"), "bits").select(*BANDED)

    def ordered(rows: DataFrame) -> DataFrame:
        return rows.repartition("block", "value").sortWithinPartitions("block", "value")

    def rooted(links: DataFrame) -> DataFrame:
        reached = components(links).withColumnRenamed("node", "id")
        return distinct.join(reached, "id", "left").withColumn("root", F.coalesce("root", "id"))

    distance = bits_apart(least)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("key"), F.xxhash64(text).alias("mark"), text.alias("text"))
    prints, _ = stored(docs.mapInArrow(run, PRINTS), "fingerprints")
    first_row = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "mark")).alias("first")
    distinct, drop_distinct = stored(
        prints.groupBy("id").agg(F.min("key").alias("low"), first_row, F.first("bits").alias("bits"), F.first("bands").alias("bands")), "distinct")
    n = distinct.count()
    release(df.sparkSession)
    first = ordered(banded(distinct.withColumn("root", F.col("id")))).mapInArrow(lambda b: _starred(b, distance), PAIRS)
    by_print = _met_by_print(prints.select("id", "fingerprint").distinct())
    some, drop_some = stored(by_print.unionByName(first).distinct(), "candidates")
    release(df.sparkSession)
    found = _verified(some, distinct, docs, shingle, n, least)
    drop_some()
    now, drop_now = stored(rooted(found), "roots")
    release(df.sparkSession)
    met, drop_met = stored(ordered(banded(now)).mapInArrow(lambda b: _wide_compared(b, distance, True), MET), "met")
    large, members = met.where("not met").drop("met"), met.where("met").drop("met")
    if not large.isEmpty():
        members = members.unionByName(
            ordered(_in_parts(large, WIDE_ROWS, "side").select(*BANDED)).mapInArrow(lambda b: _wide_compared(b, distance, False), MET).drop("met"))
    release(df.sparkSession)
    members, drop_members = stored(members, "members")
    drop_met()
    if not members.isEmpty():
        found = found.unionByName(_connected(members, distinct, docs, shingle, distance, least))
        drop_now()
        now, _ = stored(rooted(found), "roots")
    drop_members()
    lows = now.groupBy("root").agg(F.min("low").alias("component"))
    named, _ = stored(now.select("id", "root").join(lows, "root").select("id", "component", "root"), "named")
    drop_distinct()
    release(df.sparkSession)
    return prints.select("key", "mark", "id").join(named.hint("merge"), "id").select("key", "mark", "component", "root")
