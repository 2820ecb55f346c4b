"""Shards by a weighted hash tree: region, rack and shard are drawn level by level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import stored

#: ``(region, rack, shard, weight)``: the leaves of a tree.  Shards are numbered in this order.
Leaf = tuple[str, str, str, float]

#: Buckets of a shard within which rows are ranked, and the share of rows that one text under one id can have in one of them.
BUCKETS, SALTS = 1024, 64


def even_tree(regions: int, racks: int, shards: int) -> list[Leaf]:
    """A tree of equal shards."""
    return [(f"r{r}", f"r{r}k{k}", f"r{r}k{k}s{s}", 1.0) for r in range(regions) for k in range(racks) for s in range(shards)]


def grown(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own.

    No existing subtree's weight changes, so that rows move to the new shard only.
    """
    name = f"x{len(tree)}"
    return [*tree, (name, f"{name}k", f"{name}ks", weight)]


def _draw(key: Column, options: dict[str, tuple[float, Column]]) -> Column:
    """The option with the earliest arrival, which for weight w has probability w of the sum.

    An option's arrival depends on the key, its name and its weight alone.  So where weights change, rows
    move only from options that shrink or to options that grow.
    """
    if len(options) == 1:
        return next(iter(options.values()))[1]
    arrivals = []
    for name, (weight, _) in options.items():
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double")
        arrivals.append(-F.log((bits + 1.0) / float(1 << 53)) / F.lit(float(weight)))
    first = F.least(*arrivals)
    out = None
    for arrival, (_, choice) in zip(arrivals, options.values()):
        out = F.when(arrival == first, choice) if out is None else out.when(arrival == first, choice)
    return out


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard number of a key: a region is drawn by weight, in it a rack, in that a shard.

    Weights of racks and regions are the sums of their shards'.  A null key is a key like any other.
    Shards of weight zero get nothing.
    """
    if not any(leaf[3] > 0 for leaf in tree) or any(leaf[3] < 0 for leaf in tree):
        raise ValueError("weights must not be negative, and not all zero")
    if len({leaf[2] for leaf in tree}) != len(tree):
        raise ValueError("shards need different names")
    regions: dict[str, dict[str, dict[str, tuple[float, Column]]]] = {}
    for number, (region, rack, shard, weight) in enumerate(tree):
        if weight:
            regions.setdefault(region, {}).setdefault(rack, {})[shard] = (weight, F.lit(number))

    def level(children: dict, depth: int) -> tuple[float, Column]:
        if depth == 0:
            return sum(w for w, _ in children.values()), _draw(key, children)
        below = {name: level(child, depth - 1) for name, child in children.items()}
        return sum(w for w, _ in below.values()), _draw(key, below)

    return level(regions, 2)[1].cast("int")


def shards(df: DataFrame, tree: Sequence[Leaf], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's place: ``(key, size, crc, shard, slot, grown_shard)``.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none), ``crc`` its CRC-32.  ``slot`` numbers a
    shard's rows from 0 without a gap, by bucket and then by key; repeated rows get slots of their own.
    ``grown_shard`` is the shard that the key would have in :func:`grown`.  An empty table gives no rows.

    The only rows that move are narrow ones, and no task ranks more than a bucket of a shard: counts by
    shard and bucket, of which there are at most shards times ``BUCKETS``, give where each one starts.  A
    row's bucket is drawn from its key, its text and its place in the input, so that rows of one id, or copies
    of one row, are dealt over many buckets.  Buckets are in the stored table that ranks are taken from: what
    is computed again reads the same ones.
    """
    key = F.col(id_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    rows, _ = stored(
        df.select(
            key.alias("key"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"),
            shard_of(key, tree).alias("shard"), shard_of(key, grown(tree)).alias("grown_shard"),
            F.pmod(F.xxhash64(key, F.crc32(text), salt), F.lit(BUCKETS)).cast("int").alias("bucket"),
        ), "shards")
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()  # at most shards x BUCKETS rows
    starts, total = {}, dict.fromkeys(range(len(tree)), 0)
    for shard, bucket, n in sorted(counts):
        starts[shard, bucket] = total[shard]
        total[shard] += n
    spark = df.sparkSession
    start = spark.createDataFrame([(s, b, n) for (s, b), n in starts.items()], "shard int, bucket int, start long")
    return _ranked(rows, start)


def _ranked(rows: DataFrame, start: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    within = Window.partitionBy("shard", "bucket").orderBy("key", "crc", "size")
    return (
        rows.join(F.broadcast(start), ["shard", "bucket"])
        .withColumn("slot", F.col("start") + F.row_number().over(within) - 1)
        .select("key", "size", "crc", "shard", "slot", "grown_shard")
    )
