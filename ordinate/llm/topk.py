"""Exact inner-product search: a ball tree in every shard, searched by branch and bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordinate.llm.common import stored

#: Vectors of a shard on average, of a leaf at most, and queries that are searched for at a time.
SHARD, LEAF, BLOCK = 4096, 128, 4096
#: Beyond this, sums of products would not be exact in doubles.
EXACT = float(1 << 53)

TREE = "shard int, ids binary, vectors binary, width int, starts binary, stops binary, centers binary, radii binary, children binary"
FOUND = "query long, ask long, vec long, score long"


def usable(vector: Column) -> Column:
    """Whether a vector is there, without null or non-finite components."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def _tree(vectors: np.ndarray, leaf: int) -> tuple[np.ndarray, ...]:
    """An order of the vectors, and balls around runs of it: bounds, centers, radii, and the two children (or -1)."""
    order = np.arange(len(vectors))
    nodes: list[tuple] = []

    def grow(start: int, stop: int) -> int:
        own = vectors[order[start:stop]]
        center = own.mean(axis=0)
        away = np.sqrt(((own - center) ** 2).sum(axis=1))
        at = len(nodes)
        nodes.append([start, stop, center, away.max(), -1, -1])
        if stop - start > leaf:
            first = own[away.argmax()]
            second = own[((own - first) ** 2).sum(axis=1).argmax()]
            half = (stop - start) // 2
            near = np.argpartition(own @ (second - first), half)
            order[start:stop] = order[start:stop][near]
            nodes[at][4] = grow(start, start + half)
            nodes[at][5] = grow(start + half, stop)
        return at

    grow(0, len(vectors))
    start, stop, center, radius, left, right = zip(*nodes)
    return order, np.array(start), np.array(stop), np.array(center), np.array(radius), np.array([left, right]).T


def _merged(best: np.ndarray, ids: np.ndarray, rows: np.ndarray, scores: np.ndarray, vecs: np.ndarray) -> None:
    """Put further candidates among the best so far of the given queries; ties go to smaller ids."""
    k = best.shape[1]
    score = np.concatenate([best[rows], scores], axis=1)
    vec = np.concatenate([ids[rows], np.broadcast_to(vecs, scores.shape)], axis=1)
    order = np.lexsort((vec, -score), axis=1)[:, :k]
    best[rows] = np.take_along_axis(score, order, 1)
    ids[rows] = np.take_along_axis(vec, order, 1)


class Ball:
    """One shard's tree as it is stored."""

    def __init__(self, row: dict):
        width = row["width"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, width)
        self.starts, self.stops = np.frombuffer(row["starts"], np.int64), np.frombuffer(row["stops"], np.int64)
        self.centers = np.frombuffer(row["centers"], np.float64).reshape(-1, width)
        self.radii = np.frombuffer(row["radii"], np.float64)
        self.children = np.frombuffer(row["children"], np.int64).reshape(-1, 2)

    def bounds(self, queries: np.ndarray, sizes: np.ndarray, rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """No vector of a node has a larger inner product with the query.  Rounding is allowed for."""
        middle = np.einsum("ij,ij->i", queries[rows], self.centers[nodes])
        reach = sizes[rows] * self.radii[nodes]
        return middle + reach + 1e-9 * (np.abs(middle) + reach) + 1e-6

    def search(self, queries: np.ndarray, names: np.ndarray, least: np.ndarray, k: int, greedy: bool) -> tuple[np.ndarray, np.ndarray]:
        """The best scores and their ids.  Nodes that cannot reach ``least``, or a query's k-th score so far, are left out.

        :param greedy: look into the most promising leaf of each query only.
        """
        sizes = np.sqrt((queries ** 2).sum(axis=1))
        best = np.full((len(queries), k), -np.inf)
        ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        rows, nodes = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        bound = self.bounds(queries, sizes, rows, nodes)
        while len(rows):
            floor = np.maximum(least, best[:, -1])
            on = bound >= floor[rows]
            rows, nodes, bound = rows[on], nodes[on], bound[on]
            if not len(rows):
                break
            # the most promising node of each query is opened, the others wait
            order = np.lexsort((-bound, rows))
            rows, nodes, bound = rows[order], nodes[order], bound[order]
            head = np.r_[True, rows[1:] != rows[:-1]]
            row, node = rows[head], nodes[head]
            rows, nodes, bound = (x[:0] if greedy else x[~head] for x in (rows, nodes, bound))
            leaf = self.children[node, 0] < 0
            for n in np.unique(node[leaf]):
                own = row[leaf & (node == n)]
                i, j = self.starts[n], self.stops[n]
                scores = queries[own] @ self.vectors[i:j].T
                scores[self.ids[i:j] == names[own][:, None]] = -np.inf
                _merged(best, ids, own, scores, self.ids[i:j])
            row, node = row[~leaf], node[~leaf]
            if len(row):
                both = self.children[node]
                new_rows, new_nodes = np.repeat(row, 2), both.ravel()
                new_bound = self.bounds(queries, sizes, new_rows, new_nodes)
                rows, nodes, bound = np.r_[rows, new_rows], np.r_[nodes, new_nodes], np.r_[bound, new_bound]
        return best, ids


def _built(batches: Iterator[pa.RecordBatch], leaf: int) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in TREE.split(", ")]
    held: list[pa.RecordBatch] = []
    last = None

    def grown():
        table = pa.Table.from_batches(held).combine_chunks()
        shard = table.column("shard")[0].as_py()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        ids = table.column("key").to_numpy()
        vectors = flat.reshape(len(ids), -1)
        order, starts, stops, centers, radii, children = _tree(vectors, leaf)
        values = [shard, ids[order].tobytes(), vectors[order].tobytes(), vectors.shape[1], starts.tobytes(), stops.tobytes(),
                  centers.tobytes(), radii.tobytes(), children.astype(np.int64).tobytes()]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)

    for batch in batches:
        marks = np.stack([batch.column("shard").to_numpy(), batch.column("width").to_numpy()], 1)
        cuts = np.r_[0, np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1, len(marks)] if len(marks) else np.zeros(1, int)
        for i, j in zip(cuts.tolist(), cuts[1:].tolist()):
            mark = tuple(marks[i].tolist())
            if held and mark != last:
                yield grown()
                held = []
            last = mark
            held.append(batch.slice(i, j - i))
    if held:
        yield grown()


def _searched(trees: DataFrame, block: DataFrame, k: int, greedy: bool) -> DataFrame:
    """Candidates of every shard for one block of queries ``(query, ask, vector, least)``, which is broadcast: at most BLOCK rows."""
    by_width: dict[int, list] = {}
    for r in block.collect():
        by_width.setdefault(len(r["vector"]), []).append((r["query"], r["ask"], -np.inf if r["least"] is None else r["least"], r["vector"]))
    asked = {}
    for width, rows in by_width.items():
        names, asks, least, queries = zip(*rows)
        asked[width] = np.array(names, np.int64), np.array(asks, np.int64), np.array(queries, np.float64), np.array(least, np.float64)
    shared = trees.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["width"] in shared.value:
                    names, asks, queries, least = shared.value[row["width"]]
                    best, ids = Ball(row).search(queries, names, least, k, greedy)
                    there = best > -np.inf
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(np.repeat(x, k).reshape(best.shape)[there]) for x in (names, asks)), pa.array(ids[there]),
                         pa.array(best[there].astype(np.int64))], ["query", "ask", "vec", "score"])

    return trees.mapInArrow(run, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query: first within groups of shards, so that no task sees all of a query's candidates at once."""
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query", "ask").orderBy(F.desc("score"), "vec"))).where(F.col("rank") <= k)


def search(
    queries: DataFrame, vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD, leaf: int = LEAF, block: int = BLOCK,
) -> DataFrame:
    """Each query's ``k`` largest inner products over all vectors but the one of its own id.

    Vectors are dealt into shards of about ``shard_rows`` by a hash of id and content, and each shard gets a ball
    tree, which is stored.  Queries go in blocks of bounded size against all shards: first every shard
    looks into its most promising leaf, and the k-th best score of all shards becomes the bound that all
    share; then every shard searches the nodes that can still reach it, best bound first.

    Vectors that are null or empty, or hold null or non-finite components, take no part, nor do null ids.  Ties go to
    smaller ids; different vectors under one id are candidates each, and queries each, with ``k`` results of their own; repeated rows count once.  Components must be whole numbers, with inner products
    below 2**53; others raise.  Vectors of another width than a query's are no candidates of it.

    :returns: ``(query, rank, vec, score)``, ranks from 1; fewer than ``k`` rows if there are fewer candidates.
    """
    key, vector = F.col(id_col).cast("long").alias("key"), F.col(vector_col).cast("array<double>").alias("vector")

    def valid(df: DataFrame) -> DataFrame:
        whole = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
        checked = F.when((whole < EXACT) & F.forall("vector", lambda x: x == F.floor(x)), F.col("vector")).otherwise(
            F.raise_error(F.lit("components must be whole and inner products below 2**53")))
        return df.select(key, vector).where("key is not null").where(usable(F.col("vector"))).select("key", checked.alias("vector"))

    rows, drop = stored(valid(vectors).distinct().withColumn("width", F.size("vector")), "vectors")
    total = rows.count()
    shards = max(1, -(-total // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key", "vector"), F.lit(shards)).cast("int"))
    trees, _ = stored(
        dealt.repartition("shard", "width").sortWithinPartitions("shard", "width").select("shard", "width", "key", "vector")
        .mapInArrow(lambda b: _built(b, leaf), TREE).repartition(min(shards, 4096)), "trees")
    drop()
    # an id and a vector are a query: different vectors under one id each have their own answer
    asked = valid(queries).select(F.col("key").alias("query"), "vector").distinct().withColumn("ask", F.xxhash64("vector"))
    blocks = max(1, -(-asked.count() // (block // 2)))
    asked, _ = stored(asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")), "queries", ["block"])
    out = None
    for number in range(blocks):
        own = asked.where(F.col("block") == number).select("query", "ask", "vector")
        first = _top(_searched(trees, own.withColumn("least", F.lit(None).cast("double")), k, True), k)
        kth = first.where(F.col("rank") == k).select("query", "ask", F.col("score").cast("double").alias("least"))
        found, _ = stored(_top(_searched(trees, own.join(kth, ["query", "ask"], "left"), k, False), k), "found")
        out = found if out is None else out.unionByName(found)
    return out.select("query", "rank", "vec", "score")
