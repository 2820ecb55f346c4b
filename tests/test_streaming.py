"""Streams give what the batch operators give on the same rows."""

import datetime
import os
import sys
import time

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import Window, functions as F

import ordinate as o
from ordinate.functions import all_numeric
from ordinate.streaming import (
    column_state, group_by_window_stream, per_micro_batch, reduce_stream, reduced, run_available, scan_stream, short_windows, snapshot_stream,
    timed_windows, typed_scan, unique_stream,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def parts(spark, table, tmp_path):
    """Events in four files, as a stream of one file per micro-batch, in order."""
    events = table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    path = str(tmp_path / "parts")
    n = events.count()
    for i in range(4):
        part = events.where(f"event_id >= {i * n // 4} and event_id < {(i + 1) * n // 4}")
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)  # files are taken in order of modification time
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return events, stream


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_row_wise_operators(parts):
    events, stream = parts
    pipeline = lambda d: o.prepare(o.filter_rows(o.map_rows(d, {"v2": F.col("value") * 2}, keep=True), "v2 > 50"), ["value", "v2"], y="event_id")
    assert rows(run_available(pipeline(stream))) == rows(pipeline(events))


def test_positional_operators_refuse_streams(parts):
    _, stream = parts
    for call in (
        lambda: o.take(stream, 1, "event_id"), lambda: o.skip(stream, 1, "event_id"), lambda: o.batch(stream, 2, "event_id"),
        lambda: o.take_while(stream, "value < 1", "event_id"), lambda: o.window(stream, 2, "event_id"),
        lambda: o.shuffle(stream, "event_id", 1), lambda: o.interleave(stream, "user_id", "event_id"),
        lambda: o.zip_datasets((stream, "event_id"), (stream, "event_id")),
    ):
        with pytest.raises(ValueError):
            call()


def test_unique(parts):
    events, stream = parts
    got = run_available(unique_stream(stream, ["user_id", "event_type"], "ts", "3650 days").select("user_id", "event_type"))
    assert rows(got) == rows(events.select("user_id", "event_type").distinct())
    exact = run_available(unique_stream(stream.select("user_id", "event_type"), ["user_id", "event_type"]))
    assert rows(exact) == rows(got)
    with pytest.raises(ValueError):
        unique_stream(stream, ["user_id"], event_time="ts")


def test_scan(parts):
    events, stream = parts

    def emit(total, frame):
        cents = (frame.value * 100).round().astype("int64").cumsum() + total
        return int(cents.iloc[-1]), pd.DataFrame({"event_id": frame.event_id, "cents": cents})

    got = run_available(scan_stream(stream, "user_id", "event_id", 0, emit, "event_id bigint, cents bigint"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    want = o.scan(events, "event_id", {"cents": ("sum", cents)}, partition_by="user_id").select("event_id", "cents")
    assert rows(got) == rows(want)


def reduce_window(key, number, frame):
    return pd.DataFrame({"key": [key[0]], "window": [number], "size": [len(frame)], "first": [frame.event_id.min()], "last": [frame.event_id.max()]})


SCHEMA = "key bigint, window bigint, size int, first bigint, last bigint"


def test_group_by_window(parts):
    events, stream = parts
    got = run_available(group_by_window_stream(stream, "user_id", "event_id", 5, reduce_window, SCHEMA))
    want = o.group_by_window(events, "user_id", {"first": F.min("event_id"), "last": F.max("event_id")}, "event_id", window_size=5)
    assert rows(got) == rows(want.where("size = 5"))
    whole = run_available(
        group_by_window_stream(stream, "user_id", "event_id", 5, reduce_window, SCHEMA),
        rest=lambda checkpoint: short_windows(stream.sparkSession, checkpoint, reduce_window, SCHEMA))
    assert rows(whole) == rows(want)
    sized = run_available(group_by_window_stream(stream, "user_id", "event_id", lambda k: 2 + k[0] % 2, reduce_window, SCHEMA))
    assert {(r["key"] % 2, r.size) for r in sized.collect()} == {(0, 2), (1, 3)}


def test_quiet_keys_give_short_windows(parts, spark):
    events, stream = parts
    out = group_by_window_stream(stream, "user_id", "event_id", 5, reduce_window, SCHEMA, flush_after_ms=500)
    query = out.writeStream.format("memory").queryName("flushed").trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 60
        while time.time() < deadline:
            seen = spark.table("flushed").agg(F.sum("size")).first()[0]
            if seen == events.count():
                break
            time.sleep(1)
        assert seen == events.count()
    finally:
        query.stop()


def test_snapshot_resumes(parts, spark, tmp_path):
    events, stream = parts
    path = str(tmp_path / "snap")
    for _ in range(2):  # the second run finds nothing new
        snapshot_stream(stream, path).awaitTermination(120)
    assert spark.read.parquet(path + "/data").count() == events.count()


def test_per_micro_batch(parts, spark, tmp_path):
    events, stream = parts
    out = str(tmp_path / "out")
    query = per_micro_batch(stream, lambda d: o.batch(d, 100, "event_id", columns=["event_id"]), out, str(tmp_path / "progress"))
    query.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.select(F.sum("size")).first()[0] == events.count() and got.select("micro_batch").distinct().count() == 4
    assert got.where("size > 100").count() == 0


def test_fitted_spec(parts):
    events, stream = parts
    spec = (o.feature_spec(events, ["value", "event_type"], y="event_id").step_numeric_column(all_numeric(), normalizer_fn=o.scaler_min_max())
            .step_categorical_column_with_vocabulary_list("event_type").step_indicator_column("event_type")).fit()
    assert rows(run_available(spec.transform(stream))) == rows(spec.transform(events))


def test_reduce_over_micro_batches_and_restarts(spark, table, tmp_path):
    """Totals go on where they stopped, from the state, and hold what a batch reduction gives."""
    rows_of = table("events").select("event_id", "user_id", "value")
    files, totals, keyed = (str(tmp_path / name) for name in ("files", "totals", "keyed"))
    made = {"n": F.count(F.lit(1)), "last": F.max("event_id"), "cents": F.sum(F.round(F.col("value") * 100).cast("bigint"))}
    n = rows_of.count()
    for part in range(3):
        rows_of.where(f"event_id % 3 = {part}").repartition(2).write.mode("append").parquet(files)
        stream = spark.readStream.schema(rows_of.schema).option("maxFilesPerTrigger", 1).parquet(files)
        reduce_stream(stream, made, totals).awaitTermination(120)
        reduce_stream(stream, made, keyed, key="user_id").awaitTermination(120)
        sofar = rows_of.where(f"event_id % 3 <= {part}")
        assert rows(reduced(spark, totals)) == rows(o.reduce_rows(sofar, made))
        assert rows(reduced(spark, keyed, "user_id")) == rows(sofar.groupBy("user_id").agg(*[c.alias(k) for k, c in made.items()]))
    assert reduced(spark, totals).first()["n"] == n
    assert spark.read.parquet(totals + "/totals").select("micro_batch").distinct().count() == 6
    with pytest.raises(ValueError):
        reduce_stream(stream, {"user_id": F.count("*")}, totals, key="user_id")


def test_arrays_on_streams(spark, tmp_path, monkeypatch):
    """Array look-ups give what they give on a table: nulls, empty arrays, unknown values, ids without a vector."""
    from ordinate.features import held

    monkeypatch.setattr(held, "ITEMS", 3)
    data = [(0, ["b", "a", "b"]), (1, []), (2, None), (3, [None, "zz", "a"]), (4, ["c"] * 7), (5, ["b", None, "c", "a"])]
    df = spark.createDataFrame(data, "k int, w array<string>").repartition(2)
    path = str(tmp_path / "words")
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    weights = spark.createDataFrame([(0, [3.0, 4.0]), (1, [0.5, 0.25]), (3, [1.0, 1.0])], "id long, vector array<double>")
    for combiner in ("sum", "mean", "sqrtn"):
        spec = (o.feature_spec(df.where("k <> 3"), ["w"]).step_categorical_column_with_vocabulary_list("w", num_oov_buckets=1)
                .step_embedding_column("w", dimension=2, combiner=combiner, max_norm=2.0, weights=weights)
                .step_indicator_column("w")).fit()
        show = lambda d: [str((r.k, r.x.asDict())) for r in spec.transform(d, keep=["k"]).select(
            "k", F.struct("x.w", "x.indicator_w", F.transform("x.embedding_w", lambda v: F.round(v, 9)).alias("v")).alias("x")).sort("k").collect()]
        done = run_available(spec.transform(stream, keep=["k"]))
        got = [str((r.k, r.x.asDict())) for r in done.select(
            "k", F.struct("x.w", "x.indicator_w", F.transform("x.embedding_w", lambda v: F.round(v, 9)).alias("v")).alias("x")).sort("k").collect()]
        assert got == show(df)
    monkeypatch.setattr(held, "MOST_BYTES", 10)
    with pytest.raises(ValueError, match="per_micro_batch"):
        spec.transform(stream)


def test_timed_windows_over_restarts(spark, tmp_path):
    """State lives through restarts; a quiet key gives its short window once the stream's time has passed it; late rows go."""
    files, out = str(tmp_path / "files"), str(tmp_path / "out")
    schema = "k string, n int, ts timestamp, `odd name` string"
    day = lambda d: datetime.datetime(2024, 3, 1) + datetime.timedelta(days=d)
    steps = [
        [("a", 1, day(0), "x"), ("a", 0, day(0), None), ("b", 0, day(1), "y"), (None, 0, day(1), "z")],
        [("a", 2, day(2), "x"), ("a", 3, day(2), "x"), (None, 1, day(2), "z"), ("a", 9, None, "x")],
        [("a", 4, day(4), "x"), ("c", 0, day(40), "w")],
        [("late", 0, day(3), "v"), ("b", 1, day(41), "y"), ("c", 1, day(41), "w")],
        [("end", 0, day(400), "v")],
    ]

    def reduce(key, number, frame):
        return pd.DataFrame({"k": [key[0]], "window": [number], "ns": [",".join(map(str, frame.n))], "odd": [",".join(str(v) for v in frame["odd name"].fillna("-"))]})

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for number, rows_of in enumerate(steps):
        spark.createDataFrame(rows_of, schema).coalesce(1).write.mode("append").parquet(files)
        stream = spark.readStream.schema(schema).parquet(files)
        windows = timed_windows(stream, "k", "n", 3, reduce, "k string, window int, ns string, odd string", "ts", "1 day", 10 * 86_400_000)
        with column_state(spark):
            snapshot_stream(windows, out).awaitTermination(120)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    got = {tuple(r) for r in spark.read.parquet(f"{out}/data").collect()}
    assert got == {("a", 0, "0,1,2", "-,x,x"), ("a", 1, "3,4", "x,x"), (None, 0, "0,1", "z,z"), ("b", 0, "0", "y"), ("b", 1, "1", "y"), ("c", 0, "0,1", "w,w")}
    with pytest.raises(ValueError):
        timed_windows(stream.withColumn("__event_ms", F.lit(1)), "k", "n", 3, reduce, "k string", "ts", "1 day", 1)


def test_typed_scan(parts, spark):
    events, stream = parts

    def emit(held, frame):
        totals = (frame.value * 100).round().astype("int64").cumsum() + held[0]
        return (int(totals.iloc[-1]), held[1] + len(frame)), pd.DataFrame({"event_id": frame.event_id, "cents": totals, "seen": held[1]})

    made = typed_scan(stream, "user_id", "event_id", "cents bigint, n bigint", (0, 0), emit, "event_id bigint, cents bigint, seen bigint")
    with column_state(spark):
        got = run_available(made)
    cents = F.round(F.col("value") * 100).cast("bigint")
    want = events.select("event_id", F.sum(cents).over(Window.partitionBy("user_id").orderBy("event_id")).alias("cents"))
    assert rows(got.select("event_id", "cents")) == rows(want)
    assert got.agg(F.max("seen")).first()[0] > 0


def test_steps_of_events_are_few_micro_batches(spark, tmp_path):
    """However many files a step has, it is about one micro-batch; steps stay in order."""
    from ordinate.plans import streams
    from ordinate.plans.registry import Tables

    made = spark.range(400).select(
        F.col("id").alias("event_id"), (F.col("id") % 37).alias("user_id"), (F.col("id") / 4).alias("value"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"))
    made.write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which makes one file of a small step
    try:
        stream = streams._event_files(Tables(spark, str(tmp_path)))
        out = str(tmp_path / "out")
        snapshot_stream(stream, out).awaitTermination(120)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert 2 <= len([f for f in os.listdir(f"{out}/progress/commits") if f.isdigit()]) <= 6
    got = spark.read.parquet(f"{out}/data")
    assert rows(got.where("event_id >= 0")) == rows(made.select(got.columns)) and got.where("event_id < 0").count() == 1
