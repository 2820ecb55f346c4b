"""Near-duplicate vectors through a flat proximity graph, built in overlapping cluster shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordinate.llm.common import small_batches, stored
from ordinate.llm.components import components
from ordinate.llm.topk import usable

#: Vectors of a shard; larger ones are clustered again.  Clusters of one step, and rows that they are fitted on.
SHARD, CLUSTERS, SAMPLE = 1024, 32, 2048
#: Rows that are dealt out to clusters at a time.
CHUNK = 16384
#: Neighbours that are kept and looked at when edges are chosen, and how much longer a detour may be.
DEGREE, POOL, DETOUR = 24, 48, 1.2
#: Nodes that a search holds.
BEAM = 32
#: A range is widened over nodes whose cosine is this much below the threshold at most.
SLACK = 0.15
#: Queries whose links are counted by brute force, and the share of them that must be found.
AUDITED, LEAST_RECALL = 256, 0.99
#: Steps of clustering.
DEPTH = 12

MEMBERS = "shard long, key long, home boolean, vector array<double>"
PACKS = "shard long, label_id long, origin long, keys array<long>, weights array<long>, vectors binary, center array<double>, radius double"
CROSSED = "s long, t long, a long, b long, others long, found long"


def _matrix(table: pa.Table, column: str = "vector") -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)


def _centers(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from spread-out starts; the same for the same rows."""
    chosen = [0]
    near = vectors @ vectors[0]
    for _ in range(k - 1):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centers = vectors[chosen]
    for _ in range(8):
        own = (vectors @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, vectors)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(size > 0, sums / np.maximum(size, 1e-300), centers)
    return centers


def _fit(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("key").to_numpy())
    total = table.column("total")[0].as_py()
    k = min(CLUSTERS, max(2, -(-3 * total // SHARD)), table.num_rows)
    centers = _centers(_matrix(table)[order], k)
    chunks = -(-total // CHUNK)
    return pa.table({
        "shard": pa.array([table.column("shard")[0].as_py()] * chunks, pa.int64()), "chunk": pa.array(range(chunks), pa.int32()),
        "centers": pa.array([centers.ravel().tolist()] * chunks, pa.list_(pa.float64()))})


def _deal(members: pa.Table, fitted: pa.Table) -> pa.Table:
    """To the nearest cluster, and copies of home rows to the second nearest."""
    vectors = _matrix(members)
    centers = np.array(fitted.column("centers")[0].as_py()).reshape(-1, vectors.shape[1])
    order = np.argsort(-(vectors @ centers.T), axis=1, kind="stable")
    shard, home = members.column("shard").to_numpy(), members.column("home").to_numpy(zero_copy_only=False)
    again = np.flatnonzero(home) if len(centers) > 1 else np.zeros(0, np.int64)
    rows = np.r_[np.arange(len(vectors)), again]
    child = np.r_[order[:, 0], order[again, 1] if len(again) else again]
    mixed = (shard[rows].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + child.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    taken = members.take(pa.array(rows))
    return pa.table({
        "shard": pa.array((mixed ^ (mixed >> np.uint64(31))).view(np.int64)), "key": taken.column("key"),
        "home": pa.array(np.r_[home, np.zeros(len(again), bool)]), "vector": taken.column("vector")})


def cluster_shards(rows: DataFrame) -> DataFrame:
    """Deal ``(shard, key, vector)`` of unit vectors out to overlapping shards of about ``SHARD`` rows, within the given ones.

    Larger shards are split by centers fitted on a bounded sample of each, until none is left; a row's home is the
    nearest cluster, and a copy goes to the second.  Centers travel to chunks of bounded size by a grouped join.
    Rows of one shard that no clustering parts are dealt out by a hash after ``DEPTH`` steps; ``origin`` is the shard before.
    """
    now, _ = stored(rows.select("shard", "key", F.lit(True).alias("home"), "vector"), "members")
    done = None
    for step in range(DEPTH):
        sizes, _ = stored(now.groupBy("shard").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > SHARD), "sizes")
        ready = now.join(sizes.hint("merge"), "shard", "left_anti")
        done = ready if done is None else done.unionByName(ready)
        if sizes.isEmpty():
            return done.withColumn("origin", F.col("shard"))
        large = now.join(sizes.hint("merge"), "shard")
        thin = F.pmod(F.xxhash64("key", F.lit(step)), F.col("total")) < SAMPLE
        fitted = large.where(thin).groupBy("shard").applyInArrow(_fit, "shard long, chunk int, centers array<double>")
        chunk = F.pmod(F.xxhash64("key", F.lit("chunk")), F.ceil(F.col("total") / CHUNK)).cast("int")
        chunked = large.withColumn("chunk", chunk).select("shard", "chunk", "key", "home", "vector")
        now, _ = stored(
            chunked.groupBy("shard", "chunk").cogroup(fitted.groupBy("shard", "chunk")).applyInArrow(_dealt, MEMBERS), "members")
    sizes, _ = stored(now.groupBy("shard").agg(F.count(F.lit(1)).alias("total")), "sizes")
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.ceil(F.col("total") / SHARD))
    salted = now.join(sizes.hint("merge"), "shard").select(
        F.when(F.col("total") > SHARD, F.xxhash64("shard", part)).otherwise(F.col("shard")).alias("shard"), "key", "home", "vector",
        F.col("shard").alias("origin"))
    return done.withColumn("origin", F.col("shard")).unionByName(salted)


def _dealt(members: pa.Table, fitted: pa.Table) -> pa.Table:
    if not members.num_rows:
        return pa.table({"shard": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "home": pa.array([], pa.bool_()),
                         "vector": pa.array([], pa.list_(pa.float64()))})
    return _deal(members, fitted)


def _pruned(near: np.ndarray, pool: np.ndarray, degree: int, detour: float) -> list[np.ndarray]:
    """For each node, those of its pool that no chosen nearer one makes a short detour to."""
    n, width = pool.shape
    line = np.arange(n)[:, None]
    far = np.sqrt(np.maximum(2 - 2 * near[line, pool], 0))
    order = np.argsort(far, axis=1, kind="stable")
    pool, far = np.take_along_axis(pool, order, 1), np.take_along_axis(far, order, 1)
    alive = pool != line
    out = np.full((n, degree), -1, np.int64)
    for k in range(degree):
        at = alive.argmax(axis=1)
        some = alive[np.arange(n), at]
        if not some.any():
            break
        chosen = pool[np.arange(n), at]
        out[some, k] = chosen[some]
        between = np.sqrt(np.maximum(2 - 2 * near[chosen[:, None], pool], 0))
        alive &= ~((detour * between <= far) & some[:, None])
        alive[np.arange(n), at] = False
    return [row[row >= 0] for row in out]


def _reached(lists: list[np.ndarray], start: int) -> np.ndarray:
    seen = np.zeros(len(lists), bool)
    seen[start] = True
    front = [start]
    while front:
        after = np.unique(np.concatenate([lists[i] for i in front]))
        front = after[~seen[after]].tolist()
        seen[front] = True
    return seen


def _graph(table: pa.Table) -> pa.Table:
    """The adjacency lists of one shard, by robust pruning of near and spread-out neighbours; all reach all from the medoid."""
    table = table.take(pa.array(np.argsort(table.column("key").to_numpy(), kind="stable")))
    keys, vectors = table.column("key").to_numpy(), _matrix(table)
    n = len(keys)
    near = vectors @ vectors.T
    width = min(POOL, n)
    pool = np.argpartition(-near, width - 1, axis=1)[:, :width]
    spread = np.linspace(0, n - 1, min(n, 16)).astype(np.int64)
    lists = _pruned(near, np.concatenate([pool, np.broadcast_to(spread, (n, len(spread)))], axis=1), DEGREE, DETOUR)
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(lists):
        for j in row.tolist():
            back[j].append(i)
    lists = [np.unique(np.r_[row, np.array(more, np.int64)[np.argsort(-near[i, more])[:DEGREE]] if more else row[:0]])
             for i, (row, more) in enumerate(zip(lists, back))]
    medoid = _medoid(vectors)
    while not (seen := _reached(lists, medoid)).all():
        lost = int(np.flatnonzero(~seen)[0])
        inside = np.flatnonzero(seen)
        door = int(inside[near[lost, inside].argmax()])
        lists[door] = np.r_[lists[door], lost]
    return pa.table({"key": pa.array(keys), "neighbours": pa.array([keys[row].tolist() for row in lists], pa.list_(pa.int64()))})


def _medoid(vectors: np.ndarray) -> int:
    return int((vectors @ vectors.mean(axis=0)).argmax())


def _range_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For nodes of the graph: all others that a search finds with a cosine of ``least`` or more, to be verified.

    A greedy search from the medoid holds the best ``BEAM`` nodes.  Then the range is widened: neighbours of all nodes
    that are near enough, the query's own node among them, until nothing new is near.
    """
    n, m = len(vectors), len(queries)
    line = np.arange(m)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # where lists are shorter
    cosine = np.full((m, n + 1), -2.0, np.float32)
    padded = np.r_[vectors, np.zeros((1, vectors.shape[1]))]

    def visit(rows: np.ndarray, nodes: np.ndarray) -> None:
        new = ~seen[rows, nodes]
        rows, nodes = rows[new], nodes[new]
        both = np.unique(rows * (n + 1) + nodes)
        rows, nodes = both // (n + 1), both % (n + 1)
        cosine[rows, nodes] = np.einsum("ij,ij->i", vectors[queries[rows]], padded[nodes])
        seen[rows, nodes] = True

    visit(line, np.full(m, _medoid(vectors)))
    opened = np.zeros((m, n + 1), bool)
    beam = min(BEAM, n)
    active = line
    while len(active):
        best = np.argpartition(-cosine[active], beam - 1, axis=1)[:, :beam]
        value = np.where(opened[active[:, None], best], -3.0, cosine[active[:, None], best])
        at = value.argmax(axis=1)
        go = value[np.arange(len(active)), at] > -2
        active, node = active[go], best[np.arange(len(best)), at][go]
        opened[active, node] = True
        visit(np.repeat(active, links.shape[1]), links[node].ravel())
    visit(line, queries)
    while True:
        rows, nodes = np.nonzero((cosine >= least - SLACK) & ~opened)
        if not len(rows):
            break
        opened[rows, nodes] = True
        visit(np.repeat(rows, links.shape[1]), links[nodes].ravel())
    rows, nodes = np.nonzero(cosine >= least - 1e-4)
    other = nodes != queries[rows]
    return rows[other], nodes[other]


def _linked(table: pa.Table, least: float) -> pa.Table:
    """Verified links of one shard's home rows with each other."""
    table = table.take(pa.array(np.argsort(table.column("key").to_numpy(), kind="stable")))
    keys, vectors = table.column("key").to_numpy(), _matrix(table)
    inside = table.column("home").to_numpy(zero_copy_only=False)
    home = np.flatnonzero(inside)
    lists = table.column("neighbours").combine_chunks()
    flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    place = np.searchsorted(keys, flat)
    place[place == len(keys)] = 0
    local = np.where(keys[place] == flat, place, len(keys))
    links = np.full((len(keys), max(1, sizes.max(initial=0))), len(keys), np.int64)
    row = np.repeat(np.arange(len(keys)), sizes)
    links[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = local
    a, b = [], []
    for at in range(0, len(home), SHARD):
        part = home[at:at + SHARD]
        rows, nodes = _range_search(vectors, links, part, least) if len(part) else (part, part)
        own = part[rows]
        exact = inside[nodes] & (np.einsum("ij,ij->i", vectors[own], vectors[nodes]) >= least)
        a.append(keys[np.minimum(own, nodes)[exact]])
        b.append(keys[np.maximum(own, nodes)[exact]])
    none = np.zeros(0, np.int64)
    return pa.table({"a": pa.array(np.concatenate([none, *a])), "b": pa.array(np.concatenate([none, *b]))})


def _contacts(table: pa.Table, near: float) -> pa.Table:
    """Pairs of shards that are the homes of two rows of this one with a cosine of ``near`` or more."""
    vectors = _matrix(table)
    own, code = np.unique(table.column("own").to_numpy(), return_inverse=True)
    met = np.zeros((len(own), len(own)), bool)
    for at in range(0, len(vectors), SHARD):
        rows, others = np.nonzero(vectors[at:at + SHARD] @ vectors.T >= near)
        met[code[at + rows], code[others]] = True
    s, t = np.nonzero(np.triu(met | met.T, 1))
    low, high = np.minimum(own[s], own[t]), np.maximum(own[s], own[t])
    return pa.table({"s": pa.array(low, pa.int64()), "t": pa.array(high, pa.int64())})


def _pack(table: pa.Table) -> pa.Table:
    """The home rows of a shard as one row, and a ball around them."""
    vectors = np.ascontiguousarray(_matrix(table))
    center = vectors.mean(axis=0)
    center = center / max(np.linalg.norm(center), 1e-300)
    radius = float(np.arccos(np.clip(vectors @ center, -1, 1)).max())
    first = [table.column(name)[0].as_py() for name in ("shard", "label_id", "origin")]
    return pa.table({
        "shard": pa.array(first[:1], pa.int64()), "label_id": pa.array(first[1:2], pa.int64()), "origin": pa.array(first[2:], pa.int64()),
        "keys": pa.array([table.column("key").to_numpy()], pa.list_(pa.int64())),
        "weights": pa.array([table.column("n").to_numpy()], pa.list_(pa.int64())), "vectors": pa.array([vectors.tobytes()], pa.binary()),
        "center": pa.array([center.tolist()], pa.list_(pa.float64())), "radius": pa.array([radius], pa.float64())})


def _spanning(hits: np.ndarray) -> tuple[list[int], list[int]]:
    """Of the hits of rows with columns, those that connect what all of them connect."""
    rows_left, columns_left = hits.any(axis=1), hits.any(axis=0)
    rows, columns = [], []
    while rows_left.any():
        front = [(True, int(rows_left.argmax()))]
        rows_left[front[0][1]] = False
        while front:
            is_row, at = front.pop()
            left = columns_left if is_row else rows_left
            new = np.flatnonzero((hits[at] if is_row else hits[:, at]) & left).tolist()
            left[new] = False
            rows.extend([at] * len(new) if is_row else new)
            columns.extend(new if is_row else [at] * len(new))
            front.extend((not is_row, k) for k in new)
    return rows, columns


def _compared(batches, least: float):
    """Each pair of packs, side against side: links that connect all that are near, counts for each row, and whether any was close.

    Links have ``a`` and ``b``, counts ``a`` alone, and pairs that come within the slack neither.
    """
    none = np.zeros(0, np.int64)
    for batch in batches:
        for r in pa.Table.from_batches([batch]).to_pylist():
            keys, other = np.array(r["s_keys"], np.int64), np.array(r["t_keys"], np.int64)
            weights, other_weights = np.array(r["s_weights"], np.int64), np.array(r["t_weights"], np.int64)
            left = np.frombuffer(r["s_vectors"]).reshape(len(keys), -1)
            right = np.frombuffer(r["t_vectors"]).reshape(len(other), -1)
            cosine = left @ right.T
            same = r["s"] == r["t"]
            if same:
                np.fill_diagonal(cosine, -2.0)
            if cosine.max(initial=-2.0) < least - SLACK:
                continue
            hits = cosine >= least
            # border cases as the search verifies them
            i, j = np.nonzero(np.abs(cosine - least) < 1e-9)
            hits[i, j] = np.einsum("ij,ij->i", left[i], right[j]) >= least
            rows, columns = _spanning(hits)
            some, others = np.flatnonzero(hits.any(axis=1)), none if same else np.flatnonzero(hits.any(axis=0))
            a = np.r_[keys[rows], keys[some], other[others]]
            b = [*other[columns].tolist(), *[None] * (len(some) + len(others))]
            total = [*[None] * len(rows), *(hits[some] @ other_weights).tolist(), *(weights @ hits[:, others]).tolist()]
            found = [*[None] * len(rows), *hits[some].sum(axis=1).tolist(), *hits[:, others].sum(axis=0).tolist()]
            n = len(a) + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([r["s"]] * n, pa.int64()), pa.array([r["t"]] * n, pa.int64()), pa.array([*a.tolist(), None], pa.int64()),
                pa.array([*b, None], pa.int64()), pa.array([*total, None], pa.int64()), pa.array([*found, None], pa.int64())],
                ["s", "t", "a", "b", "others", "found"])


def _side_by_side(pairs: DataFrame, packs: DataFrame, least: float, near: float) -> DataFrame:
    """The pairs whose balls may hold rows with a cosine of ``near``, compared."""
    def side(x: str, names: list[str]) -> DataFrame:
        return packs.select(F.col("shard").alias(x), *[F.col(name).alias(f"{x}_{name}") for name in names]).hint("merge")

    balls, full = ["center", "radius"], ["keys", "weights", "vectors"]
    product = F.aggregate(F.zip_with("s_center", "t_center", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), product)))
    may = pairs.join(side("s", balls), "s").join(side("t", balls), "t").where(
        apart <= F.col("s_radius") + F.col("t_radius") + float(np.arccos(max(-1.0, min(1.0, near)))) + 1e-6).select("s", "t")
    return may.join(side("s", full), "s").join(side("t", full), "t").mapInArrow(lambda b: _compared(b, least), CROSSED)


def _crossings(packs: DataFrame, contacts: DataFrame, least: float) -> DataFrame:
    """Links and counts between rows of different shards, in rounds.

    Shards in contact are compared row by row.  Where rows came near each other, the shards near either side are compared
    with the other, until no pair is new: the search goes on over the borders as it does inside, a shard at a time.
    Dense groups leave a count for each row and links that connect them, not their pairs.
    """
    asked, _ = stored(contacts, "pairs")
    known, out = None, None
    while True:
        step, _ = stored(_side_by_side(asked, packs, least, least - SLACK), "crossed")
        out = step if out is None else out.unionByName(step)
        known = asked if known is None else known.unionByName(asked)
        met = out.where("a is null").select("s", "t")
        both, _ = stored(met.unionByName(met.select(F.col("t").alias("s"), F.col("s").alias("t"))), "met")
        fresh = step.where("a is null").select("s", "t")
        fresh = fresh.unionByName(fresh.select(F.col("t").alias("s"), F.col("s").alias("t")))
        ends = fresh.join(both.select(F.col("s").alias("t"), F.col("t").alias("u")), "t").where("s <> u")
        after = ends.select(F.least("s", "u").alias("s"), F.greatest("s", "u").alias("t")).distinct()
        asked, _ = stored(after.join(known, ["s", "t"], "left_anti"), "pairs")
        if asked.isEmpty():
            return out


def _audit(classes: DataFrame, degree: DataFrame, least: float) -> float:
    """The share of the true links of a bounded sample of vectors that were found."""
    asked = classes.orderBy(F.xxhash64("key", F.lit("audit")), "key").limit(AUDITED).select("shard", "key", "vector").collect()
    if not asked:
        return 1.0
    shard = np.array([r["shard"] for r in asked])
    key = np.array([r["key"] for r in asked])
    shared = classes.sparkSession.sparkContext.broadcast([np.array(r["vector"]) for r in asked])

    def run(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            own_shard, own_key = rows.column("shard").to_numpy(), rows.column("key").to_numpy()
            lists = rows.column("vector").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            counts = []
            for s, k, v in zip(shard, key, shared.value):
                at = np.flatnonzero((own_shard == s) & (own_key != k) & (sizes == len(v)))
                near = np.stack([lists[i].values.to_numpy() for i in at.tolist()]) @ v >= least if len(at) else at
                counts.append(int(near.sum()) if len(at) else 0)
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(counts, pa.int64())], ["key", "n"])

    true = classes.select("shard", "key", "vector").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    total, hit = true.join(degree.select("key", "found"), "key", "left").agg(
        F.sum("n"), F.sum(F.least("n", F.coalesce("found", F.lit(0))))).first()
    return hit / total if total else 1.0


def vector_groups(
    df: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Every vector's links to vectors of the same label with a cosine of ``least`` or more, and its component.

    Equal vectors of a label are one class, which is indexed and searched once however many there are.  Classes are dealt
    into overlapping cluster shards within their label; each shard gets a robustly pruned graph, the adjacency
    lists of a class from all its shards are united, and every class is searched in its home shard.  Shards in contact are
    then compared, and those that such pairs lead to, until none is new.  Links are verified in double precision.
    ``recall`` is what an audit of up to ``AUDITED`` classes by brute force found; below ``LEAST_RECALL`` all shards of a
    label whose balls are near enough are compared instead, which is exact, and it is 1.

    Vectors that are null, empty, zero or hold null or non-finite components, and those without a label or an id, link
    with nothing; they are components of their own.  Vectors of different widths are never compared.
    Repeated rows are vectors of their own, linked with each other.

    :returns: ``(key, n_links, component, recall)``, one row for each row.
    """
    vector = F.col(vector_col).cast("array<double>")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    rows, _ = stored(df.select(F.col(id_col).cast("long").alias("key"), F.col(label_col).cast("string").alias("label"), vector.alias("vector")), "vectors")
    ready = rows.where("key is not null and label is not null").where(usable(F.col("vector"))).withColumn("square", square)
    ready = ready.where("square > 0 and square < double('infinity')")
    known, _ = stored(ready.groupBy("label", "vector", "square").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("n")), "classes")
    # classes of one smallest id (ids that repeat with different vectors) are told apart by a number of their own
    classes, _ = stored(known.select(
        F.xxhash64("label", F.size("vector")).alias("shard"), F.xxhash64("low", "label", "vector").alias("key"), "low", "n", "label",
        F.col("vector").alias("raw"), F.transform("vector", lambda x: x / F.sqrt("square")).alias("vector")), "classes")
    members, _ = stored(cluster_shards(classes.select("shard", "key", "vector")), "shards")
    lists = members.groupBy("shard").applyInArrow(_graph, "key long, neighbours array<long>")
    united, _ = stored(lists.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours")), "lists")
    pairs = (
        members.join(united, "key").select("shard", "key", "home", "vector", "neighbours")
        .groupBy("shard").applyInArrow(lambda t: _linked(t, least), "a long, b long"))
    inner, _ = stored(pairs.distinct(), "links")
    names = classes.select("key", "low", "n")
    small_batches(df.sparkSession)
    homes = members.where("home").select("shard", "origin", "key", "vector").join(classes.select("key", "n", F.col("shard").alias("label_id")), "key")
    packs, _ = stored(homes.groupBy("shard").applyInArrow(_pack, PACKS), "packs")
    owned = members.select("shard", "key", "vector").join(members.where("home").select("key", F.col("shard").alias("own")), "key")
    contacts = owned.groupBy("shard").applyInArrow(lambda t: _contacts(t, least - SLACK), "s long, t long")
    parts = packs.select(F.col("shard").alias("s"), "origin")
    parts = parts.join(parts.withColumnRenamed("s", "t"), "origin").where("s < t").select("s", "t")
    crossed = _crossings(packs, contacts.unionByName(parts).distinct(), least)

    def degrees(inner: DataFrame, crossed: DataFrame) -> DataFrame:
        ends = inner.unionByName(inner.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = ends.join(names.select(F.col("key").alias("b"), "n"), "b").select("a", F.col("n").alias("others"), F.lit(1).cast("long").alias("found"))
        counts = near.unionByName(crossed.where("found is not null").select("a", "others", "found"))
        return stored(counts.groupBy("a").agg(F.sum("others").alias("others"), F.sum("found").alias("found")).withColumnRenamed("a", "key"), "degrees")[0]

    degree = degrees(inner, crossed)
    recall = _audit(classes, degree, least)
    if recall < LEAST_RECALL:
        label = packs.select("label_id", F.col("shard").alias("s"))
        every = label.join(label.withColumnRenamed("s", "t"), "label_id").where("s <= t").select("s", "t")
        crossed, _ = stored(_side_by_side(every, packs, least, least), "crossed")
        inner, recall = inner.limit(0), 1.0
        degree = degrees(inner, crossed)
    links = inner.unionByName(crossed.where("b is not null").select("a", "b"))
    reached = components(links)
    rooted, _ = stored(
        names.join(degree, "key", "left").join(reached.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "low", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "key").alias("root")), "rooted")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component"))
    settled = rooted.join(lows, "root").select("key", "n_links", "component")
    named, _ = stored(classes.select("key", "label", "raw").join(settled, "key").drop("key"), "settled")
    return rows.join(named.hint("merge"), (rows["label"] == named["label"]) & (rows["vector"] == named["raw"]), "left").select(
        rows["key"], F.when(rows["key"].isNotNull() & F.col("n_links").isNotNull(), F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
        F.when(rows["key"].isNotNull(), F.coalesce("component", rows["key"])).alias("component"), F.lit(float(recall)).alias("recall"))
