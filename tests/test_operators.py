"""Worked examples of every operator, with exact expected sequences."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import ordinate as o
from ordinate.functions import everything
from ordinate.order import Ordinal


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def seq(spark, n, name="v"):
    return spark.range(n).toDF(name)


def values(df, order, col):
    return [r[col] for r in df.orderBy(*([order] if isinstance(order, str) else order)).collect()]


# -- mapping -----------------------------------------------------------------

# Rows of a public table of cars, and the counts that conditions on them give.
MPG_CYL = [(21.0, 6), (21.0, 6), (22.8, 4), (21.4, 6), (18.7, 8), (18.1, 6), (14.3, 8), (24.4, 4)]


def test_map_filter(spark):
    df = seq(spark, 5)
    assert values(o.map_rows(df, {"d": F.col("v") + 100, "v": "v"}), "v", "d") == [100, 101, 102, 103, 104]
    assert values(o.map_rows(df, lambda d: {"d": d.v * 2}, keep=True), "v", "d") == [0, 2, 4, 6, 8]
    cars = spark.createDataFrame(MPG_CYL, "mpg double, cyl int")
    assert o.filter_rows(cars, "mpg >= 20 and cyl >= 6").count() == 3
    assert o.filter_rows(cars, lambda d: (d.mpg >= 20) & ~(d.cyl < 6)).count() == 3
    assert o.filter_rows(spark.sql("select cast(null as boolean) b"), "b").count() == 0


def test_map_pandas(spark):
    got = o.map_pandas(seq(spark, 10), lambda f: f.assign(sq=f.v * f.v), "v bigint, sq bigint")
    assert values(got, "v", "sq") == [i * i for i in range(10)]


def test_flat_map_keeps_order(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, ["c"])], "k int, xs array<string>")
    assert values(o.flat_map(df, "xs"), ["k", "pos"], "element") == ["a", "b", "c"]
    assert o.flat_map(df, "xs", keep_empty=True).count() == 4


def test_map_and_batch_equals_map_then_batch(spark):
    df = seq(spark, 10)
    fused = o.map_and_batch(df, {"d": F.col("v") * 2}, 4, "v")
    assert values(fused, "batch_id", "d") == [[0, 2, 4, 6], [8, 10, 12, 14], [16, 18]]
    ranked = o.enumerate_rows(df, "v")
    assert values(o.map_and_batch(ranked, {"d": "v"}, 6, Ordinal("index")), "batch_id", "size") == [6, 4]


def test_prepare(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "a"), (0, 3.0, 4.0, "b")], "y int, a double, b double, s string")
    rows = o.prepare(df, "y ~ a + b").orderBy("y").collect()
    assert [(r.x, r.y) for r in rows] == [([3.0, 4.0], 0), ([1.0, 2.0], 1)]
    named = o.prepare(df, "y ~ .", named_features=True)
    assert named.schema["x"].dataType.names == ["a", "b", "s"]
    assert o.prepare(df, ["a", "b"]).columns == ["x"]
    assert o.prepare(df, ["-y", "-s"], y="y", named=False).columns == ["_0", "_1"]
    batched = o.prepare(df, ["a"], y="y", batch_size=2, order_by="a")
    assert batched.columns == ["batch_id", "size", "x", "y"] and batched.first().x == [[1.0], [3.0]]
    with pytest.raises(TypeError):
        o.prepare(df, "y ~ .")
    with pytest.raises(ValueError):
        o.prepare(df, ["a"], y=everything())


# -- position ----------------------------------------------------------------


def test_enumerate(spark):
    df = spark.range(100, 104).toDF("v")
    assert [(r["index"], r.v) for r in o.enumerate_rows(df, "v").orderBy("v").collect()] == [
        (0, 100), (1, 101), (2, 102), (3, 103)]


def test_take_and_skip(spark, monkeypatch):
    df = seq(spark, 20)
    assert values(o.take(df, 3, "v"), "v", "v") == [0, 1, 2]
    assert o.take(df, -1, "v").count() == 20 and o.take(df, 99, "v").count() == 20
    assert values(o.skip(df, 17, "v"), "v", "v") == [17, 18, 19]
    assert o.skip(df, 0, "v").count() == 20
    assert o.skip(df, 20, "v").count() == 0 and o.skip(df, -1, "v").count() == 0
    monkeypatch.setattr("ordinate.order.SORTED_KEYS", 2)
    assert values(o.take(df, 5, "v"), "v", "v") == [0, 1, 2, 3, 4]
    assert o.take(df, 50, "v").count() == 20
    pairs = df.select((F.col("v") % 4).alias("a"), "v")
    assert values(o.skip(pairs, 6, ["a", "v"]), ["a", "v"], "v") == values(pairs, ["a", "v"], "v")[6:]
    assert values(o.take(pairs, 6, ["a", "v"]), ["a", "v"], "v") == values(pairs, ["a", "v"], "v")[:6]


def test_skip_filters_in_the_scan(table):
    plan = plan_of(o.skip(table("orders"), 700, "o_orderkey"))
    assert "Exchange" not in plan and "GreaterThanOrEqual(o_orderkey,700)" in plan


def test_take_while(spark):
    df = seq(spark, 10)
    assert values(o.take_while(df, "v < 5", "v"), "v", "v") == [0, 1, 2, 3, 4]
    assert o.take_while(df, "v < 50", "v").count() == 10
    assert o.take_while(df, "v <> 0", "v").count() == 0
    assert o.take_while(df, "if(v = 3, null, true)", "v").count() == 3
    two = df.select((F.col("v") % 2).alias("a"), "v")
    assert values(o.take_while(two, "v <> 5", ["a", "v"]), ["a", "v"], "v") == [0, 2, 4, 6, 8, 1, 3]


def test_shard(spark):
    df = spark.range(32).select((F.col("id") * 10).alias("v"))
    assert values(o.shard(df, 4, 1, "v"), "v", "v") == [10, 50, 90, 130, 170, 210, 250, 290]
    with pytest.raises(ValueError):
        o.shard(df, 4, 4, "v")


def test_repeat_concatenate_zip(spark):
    df = seq(spark, 3)
    assert values(o.repeat(df, 2), ["epoch", "v"], "v") == [0, 1, 2, 0, 1, 2]
    assert o.repeat(df, 0).count() == 0
    with pytest.raises(ValueError):
        o.repeat(df, -1)
    both = o.concatenate(df, df)
    assert values(both, ["source_id", "v"], "v") == [0, 1, 2, 0, 1, 2]
    with pytest.raises(TypeError):
        o.concatenate(df, spark.range(2).select(F.col("id").cast("int").alias("v")))
    z = o.zip_datasets((df, "v"), (spark.range(100, 110).toDF("w"), "w"))
    assert [(r["_0"].v, r["_1"].w) for r in z.orderBy("ord").collect()] == [(0, 100), (1, 101), (2, 102)]


# -- batching ----------------------------------------------------------------


def test_batch(spark):
    df = seq(spark, 10)
    assert values(o.batch(df, 4, "v"), "batch_id", "v") == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]]
    assert values(o.batch(df, 4, "v", drop_remainder=True), "batch_id", "size") == [4, 4]
    ranked = o.enumerate_rows(df, "v")
    assert values(o.batch(ranked, 4, Ordinal("index"), columns=["v"]), "batch_id", "v")[2] == [8, 9]


def test_batch_moves_rows_once(table):
    plan = plan_of(o.batch(table("orders"), 32, "o_orderkey"))
    assert plan.count("Exchange") == 1


def test_runs_of_keys_move_rows_once(table):
    events = table("events")
    for made in (
        o.group_by_window(events, "user_id", {"n": F.sum("value")}, "event_id", window_size=10),
        o.bucket_by_sequence_length(events, "length(event_type)", [5, 6], [4, 8, 16], "event_id"),
        o.rebatch(events.select("event_id", F.array("value").alias("v")), [3, 2], "event_id"),
    ):
        assert plan_of(made).count("Exchange") == 1


def test_zip_moves_each_input_once(spark, table):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of size
    try:
        made = o.zip_datasets((table("events"), "event_id"), (table("orders"), "o_orderkey"))
        assert plan_of(made).count("Exchange") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("parts", ["1", "8", "50"])
def test_batches_do_not_depend_on_partitions(spark, table, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = o.batch(table("orders").select("o_orderkey"), 64, "o_orderkey").orderBy("batch_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert [v for r in rows for v in r.o_orderkey] == list(range(len([v for r in rows for v in r.o_orderkey])))
    assert all(r.size == 64 for r in rows[:-1])


def test_summarize_batches(spark):
    got = o.summarize_batches(seq(spark, 10), 4, "v", {"s": F.sum("v")})
    assert values(got, "batch_id", "s") == [6, 22, 17]


@pytest.mark.parametrize(
    "n, first, sizes, drop, want",
    [
        (6, 2, 3, False, [[0, 1, 2], [3, 4, 5]]),
        (7, 4, 3, False, [[0, 1, 2], [3, 4, 5], [6]]),
        (7, 2, 3, True, [[0, 1, 2], [3, 4, 5]]),
        (8, 4, [2, 1, 1], False, [[0, 1], [2], [3], [4, 5], [6], [7]]),
    ],
)
def test_rebatch(spark, n, first, sizes, drop, want):
    batched = o.batch(seq(spark, n), first, "v")
    assert values(o.rebatch(batched, sizes, drop_remainder=drop), "batch_id", "v") == want


def test_unbatch_round_trip(spark):
    back = o.unbatch(o.batch(seq(spark, 11), 3, "v"), "batch_id")
    assert values(back, ["batch_id", "pos"], "v") == list(range(11))
    ragged = spark.createDataFrame([(0, [1], [1, 2])], "k int, a array<int>, b array<int>")
    with pytest.raises(Exception, match="differ in length"):
        o.unbatch(ragged, "k").collect()


def fills(spark):
    return spark.range(1, 5).select(F.expr("array_repeat(id, cast(id as int))").alias("a"), "id")


@pytest.mark.parametrize(
    "kw, want",
    [
        ({}, [[[1, 0], [2, 2]], [[3, 3, 3, 0], [4, 4, 4, 4]]]),
        ({"padded_shapes": 5}, [[[1, 0, 0, 0, 0], [2, 2, 0, 0, 0]], [[3, 3, 3, 0, 0], [4, 4, 4, 4, 0]]]),
        ({"padded_shapes": 5, "padding_values": -1},
         [[[1, -1, -1, -1, -1], [2, 2, -1, -1, -1]], [[3, 3, 3, -1, -1], [4, 4, 4, 4, -1]]]),
    ],
)
def test_padded_batch(spark, kw, want):
    got = o.padded_batch(fills(spark), 2, "id", columns=["a"], **kw)
    assert values(got, "batch_id", "a") == want


def test_padded_batch_several_columns_and_errors(spark):
    two = fills(spark).select("id", "a", F.col("a").alias("b"), F.col("a").cast("array<string>").alias("s"))
    got = o.padded_batch(two, 2, "id", padding_values={"a": -1, "b": -1})
    assert got.orderBy("batch_id").first().a == [[1, -1], [2, 2]] == got.orderBy("batch_id").first().b
    assert got.orderBy("batch_id").first().s == [["1", ""], ["2", "2"]]
    with pytest.raises(Exception, match="longer than its padded length"):
        o.padded_batch(fills(spark), 2, "id", padded_shapes=3, columns=["a"]).collect()


# The worked example of length buckets, with its result below.
LENGTHS = [[0], [1, 2, 3, 4], [5, 6, 7], [7, 8, 9, 10, 11], [13, 14, 15, 16, 17, 18, 19, 20], [21, 22]]


def test_bucket_by_sequence_length(spark):
    df = spark.createDataFrame(list(enumerate(LENGTHS)), "i int, a array<int>")
    got = o.bucket_by_sequence_length(df, "size(a)", [3, 5], [2, 2, 2], "i", columns=["a"])
    assert values(got, ["remainder", "emitted_at", "bucket"], "a") == [
        [[1, 2, 3, 4], [5, 6, 7, 0]],
        [[7, 8, 9, 10, 11, 0, 0, 0], [13, 14, 15, 16, 17, 18, 19, 20]],
        [[0, 0], [21, 22]],
    ]
    short = df.where("i < 5")
    rest = o.bucket_by_sequence_length(short, "size(a)", [3, 5], [2, 2, 2], "i", columns=["a"])
    assert values(rest, ["remainder", "emitted_at", "bucket"], "remainder") == [False, False, True]
    kept = o.bucket_by_sequence_length(short, "size(a)", [3, 5], [2, 2, 2], "i", columns=["a"], drop_remainder=True)
    assert kept.count() == 2
    edge = o.bucket_by_sequence_length(
        df, "size(a)", [3, 9], [2, 4, 1], "i", columns=["a"], pad_to_bucket_boundary=True)
    assert {len(row) for r in edge.collect() for row in r.a} == {2, 8}
    loose = o.bucket_by_sequence_length(df, "size(a)", [3, 5], [2, 2, 2], "i", columns=["a"], no_padding=True)
    assert sorted(len(x) for r in loose.collect() for x in r.a) == sorted(map(len, LENGTHS))
    with pytest.raises(Exception, match="beyond the last boundary"):
        o.bucket_by_sequence_length(df, "size(a)", [3, 5], [2, 2, 2], "i", columns=["a"],
                                    pad_to_bucket_boundary=True).collect()


def brute_windows(n, size, shift, stride, drop):
    out, w = [], 0
    while w * shift < n:
        rows = [w * shift + i * stride for i in range(size) if w * shift + i * stride < n]
        if len(rows) == size or not drop:
            out += [(w, i, v) for i, v in enumerate(rows)]
        w += 1
    return out


@pytest.mark.parametrize("size, shift, stride", [(5, None, 1), (3, 1, 1), (3, 2, 2), (2, 5, 1), (2, 3, 4), (1, 1, 1)])
@pytest.mark.parametrize("drop", [False, True])
def test_window(spark, size, shift, stride, drop):
    got = o.window(seq(spark, 23), size, "v", shift, stride, drop)
    rows = [(r.window_id, r.window_pos, r.v) for r in got.orderBy("window_id", "window_pos").collect()]
    assert rows == brute_windows(23, size, shift or size, stride, drop)


def test_group_by_window(spark):
    got = o.group_by_window(seq(spark, 10), "v % 2", None, "v", window_size=5)
    assert values(got, ["key", "window"], "v") == [[0, 2, 4, 6, 8], [1, 3, 5, 7, 9]]
    sized = o.group_by_window(seq(spark, 10), "v % 2", {"s": F.sum("v")}, "v", window_size_func=lambda k: k + 2)
    assert values(sized, ["key", "window"], "s") == [2, 10, 8, 9, 16]
    with pytest.raises(ValueError):
        o.group_by_window(seq(spark, 10), "v % 2", None, "v")


# -- aggregation ---------------------------------------------------------------


def test_reduce(spark):
    df = spark.createDataFrame([(0, 1.1), (1, 2.2), (2, 3.3)], "i int, v double")
    row = o.single_element(o.reduce_rows(df, {"s": F.sum("v"), "n": F.count("v")}))
    assert row.s / row.n == pytest.approx(2.2)
    state = o.fold_rows(df, "i", (0.0, 0), lambda s, f: (s[0] + f.v.sum(), s[1] + len(f)),
                        lambda a, b: (a[0] + b[0], a[1] + b[1]), finish=lambda s: s[0] / s[1])
    assert state == pytest.approx(2.2)
    # order matters to this one: text in order
    text = o.fold_rows(seq(spark, 50), "v", "", lambda s, f: s + "".join(f"{v}," for v in f.v), lambda a, b: a + b)
    assert text == "".join(f"{i}," for i in range(50))
    with pytest.raises(ValueError):
        o.fold_rows(df, "i", 0, lambda s, f: s, None)


def test_scan(spark):
    df = seq(spark, 10)
    assert values(o.scan(df, "v", {"s": ("sum", F.col("v"))}), "v", "s") == [0, 1, 3, 6, 10, 15, 21, 28, 36, 45]

    def emit(state, frame):
        out = frame.assign(s=frame.v.cumsum() + state)
        return state + int(frame.v.sum()), out

    got = o.scan_rows(df, "v", 0, lambda s, f: s + int(f.v.sum()), lambda a, b: a + b, emit, "v bigint, s bigint")
    assert values(got, "v", "s") == [0, 1, 3, 6, 10, 15, 21, 28, 36, 45]


def test_unique(spark):
    df = spark.createDataFrame(list(enumerate([0, 37, 2, 37, 2, 1])), "i int, v int")
    assert sorted(r.v for r in o.unique(df.select("v")).collect()) == [0, 1, 2, 37]
    assert values(o.unique(df, ["v"], order_by="i"), "i", "v") == [0, 37, 2, 1]
    assert values(o.unique(df, ["v"], order_by="i"), "i", "i") == [0, 1, 2, 5]


def test_rejection_resample(spark):
    df = spark.range(40000).select("id", (F.col("id") % 2).cast("int").alias("c"))
    got = o.rejection_resample(df, "c", [0.6, 0.4], seed=7, order_by="id", initial_dist=[0.5, 0.5])
    n = {r.class_id: r["count"] for r in got.groupBy("class_id").count().collect()}
    assert n[0] == 20000 and n[1] / n[0] == pytest.approx(2 / 3, abs=0.02)
    counted = o.rejection_resample(df, "c", [0.6, 0.4], seed=7, order_by="id")
    assert counted.count() == got.count()
    with pytest.raises(ValueError):
        o.rejection_resample(df, "c", [0.3, 0.3, 0.4], seed=7, order_by="id")
    with pytest.raises(Exception, match="class outside"):
        o.rejection_resample(df, "c + 5", [0.6, 0.4], 7, "id", [0.5, 0.5]).count()


def test_length_types_shapes(spark):
    df = seq(spark, 42)
    assert o.length(df) == 42 and o.length(spark.readStream.format("rate").load()) == float("inf")
    assert o.output_types(df) == {"v": "bigint"}
    shapes = {r.column: (r.rank, r.min_length, r.max_length) for r in o.output_shapes(fills(spark)).collect()}
    assert shapes == {"a": (1, 1, 4), "id": (0, None, None)}


# -- combining -------------------------------------------------------------------


def test_choose_from_datasets(spark):
    words = [spark.range(10).select("id", F.lit(w).alias("w")) for w in ("foo", "bar", "baz")]
    choices = o.repeat(seq(spark, 3, "c"), 3)
    got = o.choose_from_datasets([(d, "id") for d in words], choices, "c", ["epoch", "c"])
    assert values(got, "step", "w") == ["foo", "bar", "baz"] * 3
    short = [(words[0].where("id < 2"), "id"), (words[1], "id"), (words[2], "id")]
    stopped = o.choose_from_datasets(short, choices, "c", ["epoch", "c"])
    assert values(stopped, "step", "w") == ["foo", "bar", "baz", "foo", "bar", "baz"]
    skipped = o.choose_from_datasets(short, choices, "c", ["epoch", "c"], stop_on_empty=False)
    assert values(skipped, "step", "w") == ["foo", "bar", "baz", "foo", "bar", "baz", "bar", "baz"]
    none = o.choose_from_datasets([(words[0].where("id < 0"), "id"), *short[1:]], choices, "c", ["epoch", "c"])
    assert none.count() == 0


def test_sample_from_datasets(spark):
    a, b = spark.range(6000).toDF("v"), spark.range(3000).toDF("v")
    full = o.sample_from_datasets([(a, "v"), (b, "v")], seed=3, weights=[0.75, 0.25], stop_on_empty=False)
    assert full.count() == 9000
    order = ["arrival", "source_id", "source_pos"]
    rows = full.orderBy(*order).collect()
    for s in (0, 1):  # each input keeps its own order
        mine = [r.v for r in rows if r.source_id == s]
        assert mine == sorted(mine) and mine == [r.source_pos for r in rows if r.source_id == s]
    assert sum(r.source_id == 0 for r in rows[:4000]) / 4000 == pytest.approx(0.75, abs=0.03)
    stop = o.sample_from_datasets([(a, "v"), (b, "v")], seed=3, weights=[0.75, 0.25])
    kept = stop.orderBy(*order).collect()
    assert kept == rows[: len(kept)] and len(kept) < 9000
    spent = {s: sum(r.source_id == s for r in kept) for s in (0, 1)}
    assert spent[0] == 6000 or spent[1] == 3000  # it ends because one input ran out
    per_step = spark.range(500).select("id", F.when(F.col("id") < 250, F.array(F.lit(1.0), F.lit(0.0)))
                                       .otherwise(F.array(F.lit(0.0), F.lit(1.0))).alias("weights"))
    varied = o.sample_from_datasets([(a, "v"), (b, "v")], seed=3, weights=per_step, weights_order="id")
    assert values(varied, "step", "source_id") == [0] * 250 + [1] * 250


def test_shuffle(spark):
    df = seq(spark, 1000)
    s = o.shuffle(df, "v", seed=1)
    got = values(s, ["shuffle_key", "v"], "v")
    assert sorted(got) == list(range(1000)) and got != list(range(1000))
    assert got == values(o.shuffle(df.repartition(50), "v", seed=1), ["shuffle_key", "v"], "v")
    assert got != values(o.shuffle(df, "v", seed=2), ["shuffle_key", "v"], "v")
    blocks = values(o.shuffle(df, "v", seed=1, buffer_size=100), ["shuffle_key_block", "shuffle_key", "v"], "v")
    assert all(sorted(blocks[i:i + 100]) == list(range(i, i + 100)) for i in range(0, 1000, 100))
    epochs = o.shuffle_and_repeat(df, "v", 2, seed=1)
    one, two = (values(epochs.where(F.col("epoch") == e), ["shuffle_key", "v"], "v") for e in (0, 1))
    assert sorted(one) == sorted(two) == list(range(1000)) and one != two


def brute_interleave(counts, cycle, block):
    """Element by element, as the rule is stated."""
    from collections import deque

    waiting, slots, out, at = deque(enumerate(counts)), [None] * cycle, [], 0
    while waiting or any(s is not None for s in slots):
        if slots[at] is None and waiting:
            source, n = waiting.popleft()
            slots[at] = deque((source, i) for i in range(n))
        if slots[at] is not None:
            for _ in range(block):
                if not slots[at]:
                    slots[at] = None
                    break
                out.append(slots[at].popleft())
        at = (at + 1) % cycle
    return out


@pytest.mark.parametrize(
    "counts, cycle, block",
    [([6] * 5, 2, 4), ([8, 8, 3], 2, 4), ([5, 1, 9, 2, 7, 4, 4], 3, 2), ([3, 3], 1, 5), ([1, 2, 3], 10, 1)],
)
def test_interleave(spark, counts, cycle, block):
    rows = [(s, i) for s, n in enumerate(counts) for i in range(n)]
    df = spark.createDataFrame(rows, "s int, i int")
    got = o.interleave(df, "s", "i", cycle_length=cycle, block_length=block)
    ordered = [(r.s, r.i) for r in got.orderBy("round", "slot", "block_pos").collect()]
    assert ordered == brute_interleave(counts, cycle, block)


def test_interleave_example(spark):
    df = spark.range(1, 6).select("id", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("i"))
    got = o.interleave(df, "id", "i", cycle_length=2, block_length=4)
    text = "".join(str(v) for v in values(got, ["round", "slot", "block_pos"], "id"))
    assert text == "111122221122333344443344555555"


# -- materialize -----------------------------------------------------------------


def test_snapshot(spark, tmp_path):
    path = str(tmp_path / "snap")
    df = seq(spark, 10)
    assert o.snapshot(df, path).count() == 10
    # the second time the files are read, not the (now different) input
    assert o.snapshot(df.where("v < 3"), path).count() == 10
    with pytest.raises(ValueError):
        o.snapshot(df.withColumn("w", F.lit(1)), path)
    with pytest.raises(ValueError):
        o.snapshot(df, path, fingerprint="v2")
    sharded = str(tmp_path / "sharded")
    back = o.snapshot(df, sharded, "GZIP", lambda d: d.v % 2, lambda d: d.where("shard = 1"))
    assert sorted(r.v for r in back.collect()) == [1, 3, 5, 7, 9]
    with pytest.raises(ValueError):
        o.snapshot(df, path, "LZ99")


def test_cache_collect_single(spark, tmp_path):
    df = seq(spark, 100)
    assert o.cache(df).storageLevel.useMemory
    df.unpersist()
    assert o.cache(df, str(tmp_path / "c")).count() == 100
    assert len(o.collect(df, "v", 100)) == 100 and len(o.collect(df, "v", 1)) == 1
    with pytest.raises(ValueError):
        o.collect(df, "v", float("inf"))
    assert o.single_element(seq(spark, 1)).v == 0
    for n in (0, 2):
        with pytest.raises(ValueError):
            o.single_element(seq(spark, n))


@pytest.mark.parametrize("partitions", ["1", "8", "200"])
def test_starting_values_count_once(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = seq(spark, 100)
        add, step = (lambda a, b: a + b), (lambda s, f: s + int(f.v.sum()))
        assert o.fold_rows(df, "v", 10, step, add, zero=0) == 4960
        with pytest.raises(ValueError, match="zero"):
            o.fold_rows(df, "v", 10, step, add)

        def emit(state, frame):
            out = frame.v.cumsum() + state
            return int(out.iloc[-1]), frame.assign(s=out)

        got = o.scan_rows(df, "v", 10, step, add, emit, "v bigint, s bigint", zero=0).orderBy("v").collect()
        assert [r.s for r in got] == [10 + v * (v + 1) // 2 for v in range(100)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    totals = o.reduce_rows(seq(spark, 5), {"s": F.sum("v"), "m": F.min("v")}, initial={"s": ("sum", 10), "m": ("min", -3)}).first()
    assert tuple(totals) == (20, -3)


def test_states_of_folds_may_be_large(spark):
    grown = o.fold_rows(seq(spark, 10), "v", b"", lambda s, f: s + bytes(2 << 20) + bytes(map(int, f.v)), lambda a, b: a + b)
    assert len(grown) > 2 << 20 and bytes(b for b in grown if b) == bytes(range(1, 10))
    large = o.fold_rows(seq(spark, 40), "v", np.zeros(7_000_000), lambda s, f: s + int(f.v.sum()), lambda a, b: a + b)
    assert large.nbytes > 50_000_000 and (large == 780).all()


@pytest.mark.parametrize("partitions", ["1", "8", "40"])
def test_starting_values_that_are_not_neutral(spark, partitions):
    """Of the last known value a range that has none must not take the starting value for one."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(200).select(F.col("id").alias("k"), F.when(F.col("id") < 10, F.col("id").cast("double")).alias("v"))
        last = lambda s, f: f.v.dropna().iloc[-1] if f.v.notna().any() else s
        if partitions != "1":
            with pytest.raises(Exception, match="give zero"):
                o.fold_rows(df, "k", 0.0, last, lambda a, b: b)
        none = "nothing"  # a state of its own for ranges without a value
        later = lambda a, b: a if isinstance(b, str) else b
        assert o.fold_rows(df, "k", 0.0, last, later, zero=none) == 9.0

        def emit(state, frame):
            out = frame.v.ffill().fillna(state)
            return float(out.iloc[-1]), frame.assign(v=out)

        got = o.scan_rows(df, "k", 0.0, last, later, emit, "k bigint, v double", zero=none).orderBy("k").collect()
        assert [r.v for r in got] == [min(float(k), 9.0) for k in range(200)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_folds_and_scans_of_nothing(spark):
    assert o.fold_rows(seq(spark, 0), "v", 5, lambda s, f: s + len(f), lambda a, b: a + b, zero=0) == 5
    assert o.scan_rows(seq(spark, 0), "v", 0, lambda s, f: s, lambda a, b: a, lambda s, f: (s, f), "v bigint").collect() == []


def test_unique_refuses_ties(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b")], "k int, v string")
    with pytest.raises(Exception, match="do not order the rows"):
        o.unique(rows, ["v"], order_by="k").collect()
    later = spark.createDataFrame([(0, "a"), (1, "a"), (1, "a"), (3, "b")], "k int, v string")
    assert sorted(tuple(r) for r in o.unique(later, ["v"], order_by="k").collect()) == [(0, "a"), (3, "b")]


@pytest.mark.parametrize("seed", range(3))
def test_rebatch_of_uneven_batches(spark, seed):
    """Batches of any sizes, also empty ones and ones longer than a cycle, over more ranges than there are batches."""
    rng = np.random.default_rng(seed)
    batches, at = [], 0
    for k in range(60):
        n = int(rng.choice([0, 1, 2, 3, 40]))
        batches.append((k, list(range(at, at + n)), [str(x) for x in range(at, at + n)]))
        at += n
    df = spark.createDataFrame(batches, "k int, a array<int>, b array<string>").repartition(7)
    sizes = [[5], [3, 1, 2], [100], [1]][seed]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str([4, 30, 90][seed]))
    try:
        got = o.rebatch(df, sizes, "k").orderBy("batch_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want, turn = [], 0
    while sum(map(len, want)) < at:
        start = sum(map(len, want))
        want.append(list(range(start, min(at, start + sizes[turn % len(sizes)]))))
        turn += 1
    assert [r.a for r in got] == want and [r.b for r in got] == [[str(x) for x in w] for w in want]
    assert [r.batch_id for r in got] == list(range(len(want))) and [r["size"] for r in got] == [len(w) for w in want]


def test_rebatch_cuts_slices(table):
    """Batches are cut, not taken apart: nothing is made for an item, and the arrays move once."""
    batches = table("events").select("event_id", F.array("value").alias("v"))
    plan = plan_of(o.rebatch(batches, [3, 2], "event_id"))
    assert plan.count("Exchange") == 1 and "posexplode" not in plan and "slice(" in plan


def test_building_a_batch_takes_few_jobs(spark, table):
    tracker = spark.sparkContext.statusTracker()
    for make in (lambda: o.batch(table("orders"), 32, "o_orderkey"), lambda: o.take(table("orders"), 1000, "o_orderkey")):
        spark.sparkContext.setJobGroup("building", "")
        earlier = len(tracker.getJobIdsForGroup("building"))
        make()
        assert len(tracker.getJobIdsForGroup("building")) - earlier <= 6
    spark.sparkContext.setJobGroup("others", "")


def test_window_places_are_arithmetic(spark):
    """A row makes its own members only: no list as long as the window."""
    plan = plan_of(o.window(seq(spark, 10), 5000, "v"))
    assert "sequence(__first" in plan and "filter(" not in plan


def test_sources_take_their_turns(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("c", 1), ("c", 2)], "s string, n int")
    turns = o.interleave(df, "s", "n", cycle_length=2, sources=["a", "b", "c"]).orderBy("round", "slot", "block_pos").collect()
    assert [(r.s, r.n) for r in turns] == [("a", 1), ("a", 2), ("c", 1), ("c", 2)]
    turns = o.interleave(df, "s", "n", cycle_length=3, sources=["c", "b", "a"]).orderBy("round", "slot", "block_pos").collect()
    assert [(r.s, r.n, r.slot) for r in turns] == [("c", 1, 0), ("a", 1, 2), ("c", 2, 0), ("a", 2, 2)]


def test_names_that_are_taken(spark, tmp_path):
    df = spark.range(4).selectExpr("id AS v", "id AS key", "id AS shard", "id AS epoch", "id AS index", "id AS source_id", "id AS bucket")
    kept = o.snapshot(df, str(tmp_path / "s"), shard_func=lambda d: d.v % 2)
    assert sorted(r.shard for r in kept.collect()) == [0, 1, 2, 3]
    for call in (
        lambda: o.group_by_window(df, F.col("v") % 2, None, "v", 2), lambda: o.enumerate_rows(df, "v"), lambda: o.repeat(df, 2),
        lambda: o.concatenate(df, df), lambda: o.bucket_by_sequence_length(df, "v", [1], [2, 2], "v"),
    ):
        with pytest.raises(ValueError, match="already"):
            call()


def test_distributions_are_checked(spark):
    df = spark.range(30).selectExpr("id", "CAST(id % 3 AS INT) AS c")
    for target, initial in (([0.3, 0.3, 0.4], [0.5, 0.5]), ([0.5, 0.4], None), ([0.5, 0.5], [0.9, 0.3])):
        with pytest.raises(ValueError):
            o.rejection_resample(df, "c", target, seed=1, order_by="id", initial_dist=initial)
    same = [
        sorted(r.v for r in o.sample_from_datasets([(seq(spark, 40), "v"), (seq(spark, 37), "v")], seed=3, weights=w, stop_on_empty=False).collect())
        for w in ([1, 1], [1e6, 1e6], [1e9, 1e9], [1e-9, 1e-9])]
    assert same[0] == same[1] == same[2] == same[3] and len(same[0]) == 77


def test_padding_of_nested_arrays(spark):
    df = spark.createDataFrame([(0, [[1], [2, 3]]), (1, [[4, 5, 6]]), (2, [])], "k int, v array<array<int>>")
    got = o.padded_batch(df, 3, "k", columns=["v"]).first().v
    assert got == [[[1, 0, 0], [2, 3, 0]], [[4, 5, 6], [0, 0, 0]], [[0, 0, 0], [0, 0, 0]]]
    fixed = o.padded_batch(df, 3, "k", columns=["v"], padded_shapes={"v": [2, 4]}, padding_values=-1).first().v
    assert fixed[0] == [[1, -1, -1, -1], [2, 3, -1, -1]] and fixed[2] == [[-1] * 4] * 2
    with pytest.raises(ValueError):
        o.padded_batch(df, 3, "k", columns=["v"], padded_shapes={"v": [1, 2, 3]})


def test_table_functions(spark):
    """Rows from a function of a row, of a partition with a state, and of values in SQL, typed when analyzed."""
    from pyspark.sql import types as T

    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 3, "y"), (None, 4, "z"), (None, 5, "")], "k string, v int, t string").repartition(3)
    twice = o.table_function(lambda row: [(row["k"], i) for i in range(row["v"] % 3)], "k string, i int")
    assert sorted(map(tuple, o.flat_map_table(df, twice).collect()), key=str) == sorted(
        [("a", 0), ("a", 1), ("a", 0), (None, 0), (None, 0), (None, 1)], key=str)
    plan = o.flat_map_table(df.select("k", "v"), twice)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan

    def grow(seen, row):
        seen.append(row["v"])
        return ()

    whole = o.table_function(grow, "vs array<int>", start=list, finish=lambda seen: [(seen,)])
    assert sorted(r.vs for r in o.flat_map_table(df, whole, "k", "v").collect()) == [[1, 2], [3], [4, 5]]
    assert o.flat_map_table(df.where("false"), whole, "k", "v").collect() == []
    with pytest.raises(ValueError):
        o.flat_map_table(df, whole, order_by="v")
    with pytest.raises(ValueError):
        o.table_function(grow, "vs array<int>", finish=lambda seen: [])

    same = o.row_function(lambda value: [] if value is None else [(value,)], lambda kind: T.StructType([T.StructField("same", kind)]))
    o.register_functions(spark, {"test_same": same})
    out = spark.sql("SELECT v, same FROM {df} AS d, LATERAL test_same(d.t)", df=df)
    assert out.schema["same"].dataType == T.StringType() and sorted(map(tuple, out.collect())) == [(1, "x"), (3, "y"), (4, "z"), (5, "")]
    assert spark.sql("SELECT same FROM test_same(7)").schema["same"].dataType == T.IntegerType()
