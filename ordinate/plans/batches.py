"""Batches, padding, length buckets and count windows."""

from pyspark.sql import functions as F

import ordinate as o
from ordinate.plans.registry import cents, query


def joined(col, sep=","):
    return F.array_join(F.col(col).cast("array<string>"), sep)


def digest(col):
    """MD5 of all numbers of an array of arrays."""
    return F.md5(F.array_join(F.flatten(F.col(col)).cast("array<string>"), ","))


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS ord FROM customer)
SELECT ord // 50 AS batch_id, CAST(count(*) AS INTEGER) AS size,
       string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY ord) AS keys, string_agg(c_mktsegment, ',' ORDER BY ord) AS segments
FROM s GROUP BY 1
""")
def batch_customers(t):
    batches = o.batch(t.customer, 50, ["c_nationkey", "c_custkey"], columns=["c_custkey", "c_mktsegment"])
    return batches.select("batch_id", "size", joined("c_custkey").alias("keys"), joined("c_mktsegment").alias("segments"))


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS ord FROM customer),
     b AS (SELECT *, (ord // 28) * 3 + CASE WHEN ord % 28 >= 24 THEN 2 WHEN ord % 28 >= 16 THEN 1 ELSE 0 END AS batch_id FROM s)
SELECT batch_id, CAST(count(*) AS INTEGER) AS size, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY ord) AS keys
FROM b GROUP BY 1
""")
def rebatch_customers(t):
    batches = o.batch(t.customer.select("c_custkey"), 50, "c_custkey")
    return o.rebatch(batches, [16, 8, 4]).select("batch_id", "size", joined("c_custkey").alias("keys"))


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ord FROM orders)
SELECT ord // 7 AS batch_id, CAST(ord % 7 AS INTEGER) AS pos, o_orderkey, o_totalprice FROM s
""")
def unbatch_orders(t):
    batches = o.batch(t.orders, 7, ["o_orderdate", "o_orderkey"], columns=["o_orderkey", "o_totalprice"])
    return o.unbatch(batches, "batch_id")


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ord,
                  list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INTEGER)) AS a FROM conversations),
     w AS (SELECT *, ord // 16 AS batch_id, max(len(a)) OVER (PARTITION BY ord // 16) AS width FROM s)
SELECT batch_id, CAST(count(*) AS INTEGER) AS size, CAST(any_value(width) AS INTEGER) AS width,
       md5(array_to_string(flatten(list(list_resize(a, width, -1) ORDER BY ord)), ',')) AS cells
FROM w GROUP BY 1
""")
def padded_batch_turns(t):
    sized = t.conversations.select("conv_id", "turn", F.transform(F.split("text", " "), F.length).alias("letters"))
    padded = o.padded_batch(sized, 16, ["conv_id", "turn"], padding_values=-1, columns=["letters"])
    return padded.select("batch_id", "size", F.size(F.get("letters", F.lit(0))).alias("width"), digest("letters").alias("cells"))


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS ord, range(o_orderkey, o_orderkey + 1 + o_custkey % 7) AS a FROM orders)
SELECT ord // 20 AS batch_id, CAST(count(*) AS INTEGER) AS size,
       md5(array_to_string(flatten(list(list_resize(a, 8, 0) ORDER BY ord)), ',')) AS cells,
       string_agg(o_orderstatus, '' ORDER BY ord) AS statuses
FROM s GROUP BY 1 HAVING count(*) = 20
""")
def padded_batch_fixed_width(t):
    runs = t.orders.withColumn("run", F.sequence("o_orderkey", F.col("o_orderkey") + F.col("o_custkey") % 7))
    padded = o.padded_batch(
        runs, 20, "o_orderkey", padded_shapes={"run": 8}, drop_remainder=True, columns=["run", "o_orderstatus"])
    return padded.select("batch_id", "size", digest("run").alias("cells"), joined("o_orderstatus", "").alias("statuses"))


@query("""
WITH d AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda w: CAST(length(w) AS INTEGER)) AS a FROM documents),
     b AS (SELECT *, CASE WHEN len(a) >= 1000 THEN 3 WHEN len(a) >= 200 THEN 2 WHEN len(a) >= 50 THEN 1 ELSE 0 END AS bucket FROM d),
     k AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1 AS ord,
                  CASE bucket WHEN 0 THEN 16 WHEN 1 THEN 8 WHEN 2 THEN 4 ELSE 2 END AS n FROM b),
     w AS (SELECT *, ord // n AS batch, max(len(a)) OVER (PARTITION BY bucket, ord // n) AS width FROM k)
SELECT count(*) < any_value(n) AS remainder, CASE WHEN count(*) = any_value(n) THEN max(doc_id) END AS emitted_at,
       bucket, batch, CAST(count(*) AS INTEGER) AS size, CAST(any_value(width) AS INTEGER) AS width,
       md5(array_to_string(flatten(list(list_resize(a, width, 0) ORDER BY ord)), ',')) AS cells
FROM w GROUP BY bucket, batch
""")
def length_buckets_documents(t):
    words = F.split("text", " ")
    sized = t.documents.select("doc_id", "text", F.transform(words, F.length).alias("letters"))
    batches = o.bucket_by_sequence_length(
        sized, F.size(words), [50, 200, 1000], [16, 8, 4, 2], "doc_id", columns=["letters"])
    return batches.select(
        "remainder", "emitted_at", "bucket", "batch", "size",
        F.size(F.get("letters", F.lit(0))).alias("width"), digest("letters").alias("cells"))


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ord FROM events),
     w AS (SELECT g.range AS window_id FROM range((SELECT count(*) FROM events)) g
           WHERE g.range * 20 + 147 < (SELECT count(*) FROM events))
SELECT window_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
       min(event_id) AS first_event, max(event_id) AS last_event,
       CAST(sum((ord - window_id * 20) // 3) AS BIGINT) AS places
FROM w JOIN s ON ord BETWEEN window_id * 20 AND window_id * 20 + 147 AND (ord - window_id * 20) % 3 = 0 GROUP BY 1
""")
def window_events(t):
    members = o.window(t.events, 50, "event_id", shift=20, stride=3, drop_remainder=True)
    return members.groupBy("window_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(cents()).alias("cents"), F.min("event_id").alias("first_event"),
        F.max("event_id").alias("last_event"), F.sum("window_pos").alias("places"))


@query("""
WITH s AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ord FROM orders),
     w AS (SELECT ord // 7 AS window_id FROM s WHERE ord % 7 = 0)
SELECT window_id, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM w JOIN s ON ord BETWEEN window_id * 7 AND window_id * 7 + 19 GROUP BY 1
""")
def window_sliding_orders(t):
    """Windows that overlap, the short ones at the end with them."""
    members = o.window(t.orders.select("o_orderkey"), 20, "o_orderkey", shift=7)
    return members.groupBy("window_id").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ord FROM orders)
SELECT ord // 40 AS window_id, CAST(ord % 40 AS INTEGER) AS window_pos, o_orderkey FROM s
""")
def window_tumbling_orders(t):
    return o.window(t.orders, 40, ["o_orderdate", "o_orderkey"]).select("window_id", "window_pos", "o_orderkey")


@query("""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS ord FROM events)
SELECT user_id AS key, ord // 10 AS window, CAST(count(*) AS INTEGER) AS size,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, max(event_id) AS last_event
FROM k GROUP BY 1, 2
""")
def group_by_window_users(t):
    return o.group_by_window(
        t.events, "user_id", {"cents": F.sum(cents()), "last_event": F.max("event_id")}, "event_id", window_size=10)


@query("""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS ord FROM events)
SELECT event_type AS key, ord // (length(event_type) + 5) AS window, CAST(count(*) AS INTEGER) AS size,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ord) AS ids
FROM k GROUP BY 1, ord // (length(event_type) + 5)
""")
def group_by_window_types(t):
    runs = o.group_by_window(
        t.events, "event_type", None, ["ts", "event_id"], window_size_func=lambda k: F.length(k) + 5, columns=["event_id"])
    return runs.select("key", "window", "size", joined("event_id").alias("ids"))
