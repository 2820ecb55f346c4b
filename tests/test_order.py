"""Positions agree with a plain global sort, for any number of key ranges."""

import pytest

import ordinate as o
from pyspark.sql import Window, functions as F

from ordinate.order import BUCKET, Ordinal, build_index, check_order, key_at, running, with_ordinal

ORDERS = ["o_orderdate", "o_orderkey"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("buckets", [1, 8, 200])
@pytest.mark.parametrize(
    "name, order",
    [("orders", "o_orderkey"), ("orders", ORDERS), ("events", ["ts", "event_id"]), ("customer", "c_name")],
)
def test_ordinal_matches_global_sort(table, name, order, buckets):
    df = table(name)
    cols = [order] if isinstance(order, str) else order
    got = with_ordinal(df, order, buckets=buckets)
    want = df.select(*cols, (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*cols)) - 1).alias("want"))
    assert got.count() == df.count()
    assert got.join(want, cols).where("ord <> want").count() == 0


@pytest.mark.parametrize("buckets", [1, 8, 64])
@pytest.mark.parametrize("keys", [["event_type"], ["event_type", "user_id"], ["user_id"]])
def test_keyed_ordinal(table, keys, buckets):
    df = table("events")
    got = with_ordinal(df, ["ts", "event_id"], partition_by=keys, buckets=buckets)
    want = df.select("event_id", (F.row_number().over(Window.partitionBy(*keys).orderBy("ts", "event_id")) - 1).alias("w"))
    assert got.join(want, "event_id").where("ord <> w").count() == 0


def test_one_group_holds_most_rows(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 7).alias("g"))
    index = build_index(df, "id", "g", buckets=16)
    spread = index.place(df).groupBy(BUCKET).count()
    assert spread.agg(F.max("count")).first()[0] < 5000 * 0.25  # the large group is in many ranges
    got = with_ordinal(df, "id", partition_by="g", buckets=16)
    want = df.select("id", (F.row_number().over(Window.partitionBy("g").orderBy("id")) - 1).alias("w"))
    assert got.join(want, "id").where("ord <> w").count() == 0


KINDS = {
    "decimal": "cast(id * 7919 % 10007 / 100 - 30 as decimal(20,4))",
    "date": "date_add(date'1999-12-28', cast(id * 7919 % 10007 as int))",
    "timestamp": "timestamp_micros(id * 7919 % 10007 * 1000001 - 3000000000)",
    "timestamp_ntz": "cast(timestamp_micros(id * 7919 % 10007 * 1000001 - 3000000000) as timestamp_ntz)",
    "binary": "cast(md5(cast(id as string)) as binary)",
    "string": "concat(char(233 + id % 3), '\"', substr(md5(cast(id as string)), 1, 8), id)",
    "double": "(id * 7919 % 10007 - 5000) / 7",
    "float": "cast((id * 7919 % 10007 - 5000) as float) / cast(8 as float)",
    "tinyint then id": "cast(id % 100 as tinyint)",
    "boolean then id": "id % 3 = 0",
}


@pytest.mark.parametrize("kind", KINDS)
def test_key_types(spark, kind):
    df = spark.range(3000).selectExpr("id", f"{KINDS[kind]} as k")
    order = ["k", "id"] if "then id" in kind else ["k"]
    want = df.select("id", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)) - 1).alias("w"))
    for keys in (order, ["k", "id"]):
        assert with_ordinal(df, keys, buckets=16, align=10).join(want, "id").where("ord <> w").count() == 0
    grouped = with_ordinal(df, "id", partition_by="k", buckets=16)
    groups = df.select("id", (F.row_number().over(Window.partitionBy("k").orderBy("id")) - 1).alias("w"))
    assert grouped.join(groups, "id").where("ord <> w").count() == 0


def test_check_order(spark):
    df = spark.range(10).select("id", (F.col("id") % 5).alias("m"), F.when(F.col("id") > 0, F.col("id")).alias("gap"))
    check_order(df, "id")
    check_order(df, ["m", "id"])
    check_order(df, "gap")
    with pytest.raises(ValueError):
        check_order(df, "m")


def test_null_group_is_a_group(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 2).alias("g"))
    got = with_ordinal(df, "id", partition_by="g", buckets=8)
    want = df.select("id", (F.row_number().over(Window.partitionBy("g").orderBy("id")) - 1).alias("w"))
    assert got.join(want, "id").where("ord <> w").count() == 0


@pytest.mark.parametrize("every", [1, 7, 32, 100000])
def test_aligned_ranges_hold_whole_batches(table, every):
    df = table("orders")
    got = with_ordinal(df, "o_orderkey", align=every, keep_bucket=True, buckets=8)
    assert got.where("ord <> o_orderkey").count() == 0  # these keys are 0, 1, 2, ...
    spread = got.groupBy(F.expr(f"ord div {every}")).agg(F.countDistinct(BUCKET).alias("n"))
    assert spread.where("n > 1").count() == 0


@pytest.mark.parametrize("buckets", [4, 64])
def test_aligned_ranges_hold_whole_runs_of_groups(table, buckets):
    df = table("events")
    size = F.length("event_type")
    got = with_ordinal(df, ["ts", "event_id"], partition_by="event_type", align=size, keep_bucket=True, buckets=buckets)
    want = df.select("event_id", (F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id")) - 1).alias("w"))
    assert got.join(want, "event_id").where("ord <> w").count() == 0 and got.count() == df.count()
    runs = got.groupBy("event_type", F.floor(F.col("ord") / size)).agg(F.countDistinct(BUCKET).alias("n"))
    assert runs.where("n > 1").count() == 0
    assert got.select(BUCKET).distinct().count() > 3


def test_start_and_existing_ordinal(spark):
    df = spark.range(100, 104).toDF("v")
    rows = with_ordinal(df, "v", start=10).orderBy("v").collect()
    assert [(r.ord, r.v) for r in rows] == [(10, 100), (11, 101), (12, 102), (13, 103)]
    again = with_ordinal(with_ordinal(df, "v"), Ordinal("ord"), "again")
    assert again.where("again <> ord").count() == 0


def test_empty_input(spark):
    assert with_ordinal(spark.range(0), "id").count() == 0
    assert running(spark.range(0), "id", {"s": ("sum", F.col("id"))}).count() == 0


@pytest.mark.parametrize("keys", [[], ["event_type"]])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_measures(table, keys, exclusive):
    df = table("events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    measures = {
        "s": ("sum", F.col("cents")), "lo": ("min", F.col("cents")),
        "hi": ("max", F.col("value")), "n": ("count", F.col("value")),
    }
    got = running(df, "event_id", measures, keys, exclusive, buckets=16)
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("event_id").rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else 0)
    want = df.select("event_id", *[getattr(F, k)(c).over(w).alias("w_" + n) for n, (k, c) in measures.items()])
    both = got.join(want, "event_id")
    assert both.count() == df.count()
    for n in measures:
        assert both.where(~F.col(n).eqNullSafe(F.col("w_" + n))).count() == 0, n


@pytest.mark.parametrize("most", [1, 4096])
def test_key_at(table, most, monkeypatch):
    monkeypatch.setattr("ordinate.order.SORTED_KEYS", most)
    df = table("orders")
    rows = [r.o_orderkey for r in df.orderBy(*ORDERS).collect()]
    for position in (0, 1, 777, len(rows) - 1):
        _, key = key_at(df, ORDERS, position)
        assert key[1] == rows[position]
    assert key_at(df, ORDERS, len(rows))[1] is None


@pytest.mark.parametrize("most", [3, 4096])
def test_nulls_come_first(spark, most, monkeypatch):
    monkeypatch.setattr("ordinate.order.SORTED_KEYS", most)
    one = spark.createDataFrame([(None,), (3,), (1,), (2,)], "v int").repartition(3)
    two = spark.createDataFrame([(None, 2), (None, None), (1, None), (1, 5), (0, 9)], "v int, w int").repartition(3)
    for df, order, want in ((one, ["v"], [(None,), (1,), (2,), (3,)]), (two, ["v", "w"], [(None, None), (None, 2), (0, 9), (1, None), (1, 5)])):
        ranked = with_ordinal(df, order, buckets=3).collect()
        assert sorted((r.ord, tuple(r)[:-1]) for r in ranked) == list(enumerate(want))
        for n in range(len(want) + 1):
            assert sorted(map(str, map(tuple, o.skip(df, n, order).collect()))) == sorted(map(str, want[n:]))
            assert sorted(map(str, map(tuple, o.take(df, n, order).collect()))) == sorted(map(str, want[:n]))
        for stop in want:
            before = o.take_while(df, f"NOT (v <=> {'NULL' if stop[0] is None else stop[0]})", order).collect()
            assert len(before) == [w[0] for w in want].index(stop[0])


def test_equal_keys_raise(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 4)], "v int, w int").repartition(2)
    for call in (
        lambda: with_ordinal(df, "v"), lambda: running(df, "v", {"s": ("sum", F.col("w"))}), lambda: o.take(df, 2, "v"), lambda: o.skip(df, 2, "v"),
        lambda: o.take_while(df, "v <> 1", "v"), lambda: o.batch(df, 2, "v"), lambda: o.window(df, 2, "v"), lambda: o.shard(df, 2, 0, "v"),
        lambda: o.enumerate_rows(df, "v"), lambda: o.group_by_window(df, F.lit(1), None, "v", 2),
    ):
        with pytest.raises(Exception, match="do not order|stands twice"):
            call().collect()
    with pytest.raises(Exception, match="do not order"):
        o.fold_rows(df, "v", 0, lambda s, f: s + len(f), lambda a, b: a + b)
    assert len(o.take(df, 3, "v").collect()) == 3  # the boundary lies between different keys


def test_ranking_reads_and_moves_rows_once(table):
    plan = plan_of(with_ordinal(table("orders"), "o_orderkey"))
    assert plan.count("Exchange") == 1
    assert "SinglePartition" not in plan


def test_order_is_required_and_streams_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        with_ordinal(spark.range(3), [])
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        with_ordinal(stream, "value")
