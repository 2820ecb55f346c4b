"""Operators on vectors, pages and links, the queries, and the pipeline."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ordinate.llm import QUERIES, SQL, repeats, topk, vectors, warc
from ordinate.llm.components import components

VECTORS = "vec_id long, embedding array<float>, label int, key long, vector string, shard int, n_links int, low string"


def near(rows):
    return sorted(rows, key=repr)


# --- components


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5001 + k) for k in range(80)] + [(7, 7), (None, 3), (-5, 2000)] + [(1, 2)] * 3
    low = {n: n for pair in links if None not in pair for n in pair if pair[0] != pair[1]}
    while True:
        before = dict(low)
        for a, b in links:
            if a in low and b in low and a != b:
                low[a] = low[b] = min(low[a], low[b])
        if before == low:
            break
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert near(map(tuple, got)) == near(low.items())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- vectors


def plain_groups(rows, least):
    def good(v, label):
        return v is not None and len(v) and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    group, links = {k: k for k in range(len(rows))}, collections.Counter()
    for i, (a, v, p) in enumerate(rows):
        for j, (b, w, q) in enumerate(rows[:i]):
            if a is not None and b is not None and good(v, p) and good(w, q) and p == q and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= least:
                    links[i] += 1
                    links[j] += 1
                    old, new = group[i], group[j]
                    group = {k: new if g == old else g for k, g in group.items()}
    lows = collections.defaultdict(list)
    for k, g in group.items():
        lows[g].append(rows[k][0])
    # ids are whole in this test, save for one row that links with nothing
    return [(rows[k][0], links[k], min((x for x in lows[group[k]] if x is not None), default=None)) for k in range(len(rows))]


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", 2, 3, "l") for r in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("most", [1024, 60])
def test_vector_groups(spark, monkeypatch, most):
    monkeypatch.setattr(vectors, "SHARD", most)
    rng = np.random.default_rng(1)
    base = rng.standard_normal((260, 16)).astype(np.float32)
    rows = [(k, base[k].tolist(), k % 3) for k in range(260)]
    for k in range(120):  # near copies in crowds, some in a chain
        rows.append((300 + k, (base[k % 7] + 0.06 * rng.standard_normal(16)).astype(np.float32).tolist(), (k % 7) % 3))
    rows += [(500 + k, base[3].tolist(), 0) for k in range(50)]  # copies
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 16, 1), (603, [float("nan"), *[1.0] * 15], 1), (604, [float("inf"), *[1.0] * 15], 1),
             (605, [None, *[1.0] * 15], 1), (606, base[5].tolist(), None), (607, [1.0, 2.0], 1), (608, [2.0, 4.0], 1), (None, base[5].tolist(), 2),
             (609, (2 * base[8]).tolist(), 2), (610, base[9].tolist(), 0), (610, base[9].tolist(), 0)]
    got = vectors.vector_groups(frame_of(spark, rows), 0.93).collect()
    assert near((r.key, r.n_links, r.component) for r in got) == near(plain_groups(rows, 0.93))
    assert {r.recall for r in got} == {1.0}


@pytest.mark.parametrize("whole", [False, True])
def test_vector_groups_of_a_crowd_larger_than_a_shard(spark, monkeypatch, whole):
    """Different vectors that are all near each other, many times a shard: every link counts."""
    monkeypatch.setattr(vectors, "SHARD", 60)
    if whole:
        monkeypatch.setattr(vectors, "LEAST_RECALL", 2.0)
    rng = np.random.default_rng(4)
    center = rng.standard_normal(16)
    crowd = center / np.linalg.norm(center) + 0.04 * rng.standard_normal((500, 16))
    rows = [(k, v.tolist(), 1) for k, v in enumerate(crowd.astype(np.float32))]
    rows += [(1000 + k, v.tolist(), k % 2) for k, v in enumerate(rng.standard_normal((200, 16)).astype(np.float32))]
    got = vectors.vector_groups(frame_of(spark, rows), 0.93).collect()
    assert sum(r.n_links for r in got) > 500 * 250
    assert near((r.key, r.n_links, r.component) for r in got) == near(plain_groups(rows, 0.93))
    assert {r.recall for r in got} == {1.0}


def test_vector_groups_of_nothing(spark):
    assert vectors.vector_groups(frame_of(spark, [])).collect() == []
    alone = vectors.vector_groups(frame_of(spark, [(1, None, None)])).collect()
    assert [(r.key, r.n_links, r.component) for r in alone] == [(1, 0, 1)]


def test_graph_reaches_every_node():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    rows = rng.standard_normal((200, 8))
    rows[:80] = rows[0] + 0.01 * rng.standard_normal((80, 8))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    table = pa.table({"key": pa.array(range(200)), "vector": pa.array(rows.tolist())})
    lists = [np.array(x, np.int64) for x in vectors._graph(table).column("neighbours").to_pylist()]
    assert vectors._reached(lists, vectors._medoid(rows)).all()


# --- top k


def plain_top(rows, asked, k):
    good = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q in asked:
            scores = sorted((-int(v @ w), i) for i, w in {(i, tuple(w)) for i, w in good} if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("shard", [4096, 40])
def test_search(spark, shard):
    rng = np.random.default_rng(4)
    rows = [(k, rng.integers(-50, 50, 6).astype(float).tolist()) for k in range(300)]
    rows += [(400 + k, rows[5][1]) for k in range(30)]  # ties
    rows += [(500, None), (501, []), (502, [float("nan")] * 6), (503, [None, *[1.0] * 5]), (504, [1.0, 2.0]), (505, [3.0, 4.0]), (None, [1.0] * 6),
             (0, rows[0][1]), (506, [0.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = {0, 5, 50, 100, 410, 500, 504, 506}
    got = topk.search(frame.where(F.col("vec_id").isin(list(asked))), frame, 5, shard_rows=shard, leaf=8, block=4).collect()
    assert near((r["query"], r["rank"], r.vec, r.score) for r in got) == near(set(plain_top(rows, asked, 5)))


def test_search_query_leaves_out_odd_vectors(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [0.1, 0.2]), (2, [nan, 1.0]), (3, [inf, 1.0]), (50, [nan, nan]), (100, None), (4, [-0.001, 0.0]), (150, [None, 1.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in QUERIES["op9_topk"](spark, str(tmp_path)).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 4, -128), (0, 2, 1, 25 * 128 - 51 * 64)] or got == [(0, 1, 1, 25 * 128 - 51 * 64), (0, 2, 4, -128)]


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    one = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert topk.search(none, none).collect() == topk.search(one, none).collect() == topk.search(one, one).collect() == []
    with pytest.raises(Exception, match="whole"):
        topk.search(one, spark.createDataFrame([(2, [0.5, 2.0])], "vec_id long, embedding array<double>")).collect()


# --- archive


def test_archive(spark):
    big, small = "<p>é" * 40, "tiny"
    pages = [(1, "http://a", small), (2, "http://b", small), (7, "http://c", big), (5, "http://d\r\nX: y", big), (9, None, big), (5, "http://d\r\nX: y", big),
             (3, "http://e", None), (4, "http://f", ""), (None, "http://g", big), (None, "http://h", "alone" * 30), (8, "u", "WARC/1.1\r\n\r\n" * 20)]
    frame = spark.createDataFrame([(*p, "k", "d") for p in pages], "page_id long, url string, html string, key string, digest string").repartition(3)
    got = warc.archived(frame).collect()
    data = [(i, (h or "").encode()) for i, _, h in pages]
    want = []
    for i, b in data:
        first = min((k for k, x in data if x == b and k is not None), default=None)
        again = len(b) >= 100 and first is not None and first != i
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first if again else None, b))
    assert near((r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in got) == near(want)
    for r in warc.record_bytes(warc.archived(frame)).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and block.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(block) - 4
        assert (fields[b"WARC-Type"] == b"response") == (b"WARC-Refers-To" not in fields) and b"X" not in fields
    assert warc.archived(frame.where("false")).collect() == []


def test_archive_holds_bytes_once(spark, tmp_path):
    frame = spark.range(500).selectExpr("id AS page_id", "'u' AS url", "repeat('x', 100 + CAST(id % 3 AS INT)) AS html")
    warc.write_archive(frame, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/payloads").count() == 3
    assert spark.read.parquet(f"{tmp_path}/headers").count() == 500


# --- queries and pipeline


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    database = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    got = QUERIES[name](spark, folder)
    cursor = database.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert near(tuple(r[n] for n in names) for r in got.collect()) == near(cursor.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_every_row(spark, name):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES[name](spark, folder).collect()
    table, key = {"op5": ("embeddings", "vec_id"), "op10": ("pages", "page_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    if name.startswith("op9"):
        assert len(rows) == 5 * spark.read.parquet(f"{folder}/embeddings.parquet").where("vec_id % 50 = 0").count()
    else:
        assert {r[key] for r in rows} == {r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()}


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline

    folder, out = "/root/testdata/sf0.01", []
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after, _ = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_pipeline_keeps_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes and 0 < after.count() <= before.count()


def test_pipeline_near_duplicates(stages):
    """Of two texts whose five-word shingles are alike to 0.9 or more one goes, and texts without a like one stay."""
    _, before, after = stages[1]
    rows = sorted((r.doc_id, r.text) for r in before.select("doc_id", "text").collect())
    kept = {r.doc_id for r in after.collect()}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, t in rows for w in [t.lower().split()]}
    holders = collections.defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    best = collections.Counter()
    for i, own in sets.items():
        for j, n in collections.Counter(j for s in own for j in holders[s][:400] if j != i).items():
            alike = n / len(own | sets[j])
            best[i] = max(best[i], alike)
            if alike >= 0.9:
                assert i not in kept or j not in kept, (i, j, alike)
    assert all(i in kept for i in sets if best[i] < 0.6)
    assert len(kept) < len(rows)


def test_pipeline_repeats(stages):
    _, before, after = stages[2]
    assert repeats.without_repeats(after).agg(F.sum("n_removed")).first()[0] < 0.01 * before.agg(F.sum(F.octet_length("text"))).first()[0]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert r.n_chars == len(r.text) <= len(texts[r.doc_id])


def test_pipeline_secrets_and_packing(spark, stages):
    import re

    _, before, after = stages[3]
    assert after.count() == before.count()
    assert not [r for r in after.collect() if re.search(r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{6}|[0-9a-f]{24}", r.text)]
    _, docs, pieces = stages[4]
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}


def test_pipeline_runs_as_its_stages(spark, stages):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, "/root/testdata/sf0.01")
    total = got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    want = stages[-1][2].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert near(map(tuple, total)) == near(map(tuple, want))


DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long, key long, mark string"


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, one very long text, and tables without a row."""
    import corpus_pipeline

    folder = str(tmp_path)
    spark.read.parquet("/root/testdata/sf0.01/documents.parquet").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id"), "doc_id").limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rng = random.Random(6)
    prose = [" ".join("".join(rng.choice("abcdeist") for _ in range(6)) for _ in range(300)) for _ in range(3)]
    long = " ".join("".join(rng.choice("abcdeist") for _ in range(6)) for _ in range(40000))
    rows = [(1, prose[0]), (2, prose[0]), (3, prose[1]), (3, prose[1]), (4, None), (5, ""), (None, prose[2]), (None, prose[2]), (None, prose[0]), (6, long),
            (7, "password=hunter22 user"), (7, "quite another text of the same id, as long as a sentence is")]
    docs = spark.createDataFrame([(i, t, None, None, None, 1, "m") for i, t in rows], DOCUMENT)
    stages = dict(corpus_pipeline.STAGES)
    alike = stages["near_duplicates"](spark, docs, folder)
    assert near((r.doc_id, r.text) for r in alike.collect() if r.doc_id not in (4, 7)) == near([(1, prose[0]), (3, prose[1]), (None, prose[2]), (6, long)])
    assert [r.doc_id for r in alike.collect()].count(4) == 1 and 5 not in [r.doc_id for r in alike.collect()]
    left = stages["repeats"](spark, docs, folder).collect()
    assert near((r.doc_id, r.n_chars) for r in left) == near([(6, len(long)), (7, 22), (7, 59)])
    clean = stages["secrets"](spark, docs, folder)
    assert clean.count() == len(rows) and "[assign] user" in {r.text for r in clean.collect()}
    assert {r.doc_id for r in stages["packing"](spark, docs, folder).collect()} == {i for i, _ in rows}
    assert stages["quality"](spark, docs, folder).count() == 0  # nothing is known: no text is rated good
    for name, stage in stages.items():
        assert stage(spark, docs.where("false"), folder).count() == 0, name


def test_pipeline_near_duplicates_of_repeated_ids(spark):
    """Groups whose smallest ids are equal keep one row each, and always the same one."""
    import corpus_pipeline

    rng = random.Random(8)
    a, b, c = (" ".join("".join(rng.choice("abcdeist") for _ in range(6)) for _ in range(200)) for _ in range(3))
    rows = [(5, a), (5, b), (9, b + " more"), (5, c), (5, c + " end"), (None, a + " more")]
    docs = spark.createDataFrame([(i, t, None, None, None, 1, "m") for i, t in rows], DOCUMENT)
    kept = [near((r.doc_id, r.text) for r in corpus_pipeline.distinct(spark, docs.repartition(n), "").collect()) for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 3
    assert {(5, a), (5, b)} < set(kept[0]) and {t for _, t in kept[0]} & {c, c + " end"}
