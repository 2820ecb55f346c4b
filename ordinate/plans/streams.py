"""Streaming forms, run over the files that are there now."""

from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

import ordinate as o
from ordinate.features import feature_spec, use_spec
from ordinate.plans.registry import query
from ordinate.streaming import (
    column_state, group_by_window_stream, per_micro_batch, reduce_stream, reduced, run_available, scan_stream, short_windows, timed_windows,
    typed_scan, unique_stream,
)
from ordinate.scratch import scratch_path


def _events(t):
    files = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1)
    return files.parquet(t.folder)


@query("""
SELECT event_id, CAST(round(value * 100) AS BIGINT) AS cents, CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events WHERE event_type <> 'error'
""")
def stream_rows(t):
    made = o.map_rows(o.filter_rows(_events(t), "event_type <> 'error'"), {
        "event_id": "event_id", "cents": F.round(F.col("value") * 100).cast("bigint"),
        "k": F.get_json_object("props", "$.k").cast("int")})
    return run_available(made)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_unique(t):
    return run_available(unique_stream(_events(t).select("user_id", "event_type"), ["user_id", "event_type"]))


@query("""
SELECT event_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cents FROM events
""")
def stream_scan(t):
    def emit(total, frame):
        cents = (frame.value * 100).round().astype("int64").cumsum() + total
        return int(cents.iloc[-1]), pd.DataFrame({"event_id": frame.event_id, "cents": cents})

    rows = _events(t).select("event_id", "user_id", "value")
    return run_available(scan_stream(rows, "user_id", "event_id", 0, emit, "event_id bigint, cents bigint"))


@query("""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS ord FROM events)
SELECT user_id AS key, ord // 10 AS window, min(event_id) AS first_event, max(event_id) AS last_event,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM k GROUP BY 1, 2
""")
def stream_group_by_window(t):
    def reduce(key, number, frame):
        cents = int((frame.value * 100).round().astype("int64").sum())
        return pd.DataFrame({"key": [key[0]], "window": [number], "first_event": [frame.event_id.min()],
                             "last_event": [frame.event_id.max()], "cents": [cents]})

    rows = _events(t).select("event_id", "user_id", "value")
    schema = "key bigint, window bigint, first_event bigint, last_event bigint, cents bigint"
    windows = group_by_window_stream(rows, "user_id", "event_id", 10, reduce, schema)
    return run_available(windows, rest=lambda checkpoint: short_windows(t.spark, checkpoint, reduce, schema))


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events")
def stream_micro_batches(t):
    """A positional operator on every micro-batch: one file is one batch."""
    path = scratch_path(t.spark, "micro-batches")
    query = per_micro_batch(
        _events(t).select("event_id"), lambda batch: o.enumerate_rows(batch, "event_id", name="place"), f"{path}/rows", f"{path}/progress")
    query.awaitTermination()
    return t.spark.read.parquet(f"{path}/rows").select("event_id", "place")


def _event_files(t):
    """Events in four steps of their ids, each user's of a step in one file, and a last file with a mark of a later time.

    A micro-batch takes as many files as a step has at most, so that there are no more micro-batches when there are more events.
    """
    path = scratch_path(t.spark, "steps")
    rows = t.events.select("event_id", "user_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    most, latest = rows.agg(F.max("event_id"), F.max("ts")).first()
    for step in range(4):  # one after the other, as streams read files by their age
        mine = rows.where(F.expr(f"event_id * 4 div {(most or 0) + 1} = {step}"))
        mine.repartition("user_id").write.parquet(f"{path}/step={step}")
    mark = t.spark.range(1).select(F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"), F.lit(0.0).alias("value"),
                                   F.timestamp_add("DAY", F.lit(365), F.lit(latest)).alias("ts"))
    mark.write.parquet(f"{path}/step=4")
    files = Counter(file.rsplit("/", 2)[1] for file in t.spark.read.parquet(path).inputFiles())
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", max(files.values()))
    return stream.parquet(path).select("event_id", "user_id", "value", "ts")


@query("""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS ord FROM events)
SELECT user_id AS key, ord // 10 AS window, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM k GROUP BY 1, 2
""")
def stream_timed_windows(t):
    """Windows of ten events of each user over several micro-batches; a later event's time gives out the short ones."""
    def reduce(key, number, frame):
        cents = int((frame.value * 100).round().astype("int64").sum())
        return pd.DataFrame([(key[0], number, len(frame), frame.event_id.min(), frame.event_id.max(), cents)], columns=columns)

    columns = ["key", "window", "n", "first_event", "last_event", "cents"]
    schema = ", ".join(f"{name} bigint" for name in columns)
    windows = timed_windows(_event_files(t), "user_id", "event_id", 10, reduce, schema, "ts", "60 days", quiet_ms=60 * 86_400_000)
    with column_state(t.spark):
        return run_available(windows).where("key >= 0")


@query("""
SELECT event_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cents,
       row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events
""")
def stream_typed_scan(t):
    """Running totals and counts of each user over several micro-batches, as two columns of state."""
    def emit(held, frame):
        cents = (frame.value * 100).round().astype("int64").cumsum() + held[0]
        out = pd.DataFrame({"event_id": frame.event_id, "cents": cents, "n": range(held[1] + 1, held[1] + 1 + len(frame))})
        return (int(cents.iloc[-1]), held[1] + len(frame)), out

    rows = typed_scan(_event_files(t), "user_id", "event_id", "cents bigint, n bigint", (0, 0), emit, "event_id bigint, cents bigint, n bigint")
    with column_state(t.spark):
        return run_available(rows).where("event_id >= 0")


def _line_files(t):
    """Line items in files by the year they shipped in, as a stream of one file per micro-batch."""
    path = scratch_path(t.spark, "years")
    rows = t.lineitem.select("l_quantity", "l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
                             F.year("l_shipdate").alias("year"))
    rows.repartition("year").write.partitionBy("year").parquet(path)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query("""
SELECT count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
       max(l_quantity) AS largest FROM lineitem
""")
def stream_reduce(t):
    path = scratch_path(t.spark, "totals")
    totals = {"n": F.count(F.lit(1)), "cents": F.sum("cents"), "largest": F.max("l_quantity")}
    reduce_stream(_line_files(t), totals, path).awaitTermination()
    return reduced(t.spark, path)


@query("""
SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1
""")
def stream_reduce_by_key(t):
    path = scratch_path(t.spark, "totals")
    totals = {"n": F.count(F.lit(1)), "cents": F.sum("cents")}
    reduce_stream(_line_files(t), totals, path, key="l_returnflag").awaitTermination()
    return reduced(t.spark, path, key="l_returnflag")


@query("""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS words FROM conversations),
     i AS (SELECT conv_id, turn, unnest(words) AS word, unnest(range(len(words))) AS pos FROM w),
     v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS id FROM (SELECT DISTINCT word FROM i)),
     x AS (SELECT conv_id, turn, string_agg(v.id, ',' ORDER BY pos) AS ids FROM i JOIN v USING (word) GROUP BY 1, 2),
     n AS (SELECT conv_id, turn, count(*) AS n FROM i JOIN v USING (word) JOIN embeddings ON vec_id = v.id GROUP BY 1, 2),
     p AS (SELECT conv_id, turn, d, sum(embedding[d]::DOUBLE) AS s
           FROM i JOIN v USING (word) JOIN embeddings ON vec_id = v.id, range(1, 65) r(d) GROUP BY 1, 2, 3),
     e AS (SELECT conv_id, turn, CAST(sum(d * CAST(round(s / n * 1000000) AS BIGINT)) AS BIGINT) AS digest FROM p JOIN n USING (conv_id, turn) GROUP BY 1, 2)
SELECT conv_id, turn, ids, coalesce(digest, 0) AS digest FROM x LEFT JOIN e USING (conv_id, turn)
""")
def stream_words(t):
    """Words looked up in a vocabulary, and the vectors of their ids, on a stream of four micro-batches."""
    path = scratch_path(t.spark, "turns")
    words = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("words"))
    words.repartition(4, "conv_id").write.parquet(path)
    vectors = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    spec = (feature_spec(words, ["words"]).step_categorical_column_with_vocabulary_list("words")
            .step_embedding_column("words", dimension=64, combiner="mean", weights=vectors)).fit()
    stream = t.spark.readStream.schema(words.schema).option("maxFilesPerTrigger", 1).parquet(path)
    x = run_available(use_spec(stream, spec, keep=["conv_id", "turn"]))
    sums = F.aggregate(F.transform("x.embedding_words", lambda v, i: (i + 1) * F.round(v * 1000000).cast("bigint")), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return x.select("conv_id", "turn", F.array_join(F.col("x.words").cast("array<string>"), ",").alias("ids"), sums.alias("digest"))
