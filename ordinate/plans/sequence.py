"""Row-wise and positional operators."""

from pyspark.sql import functions as F

import ordinate as o
from ordinate.plans.registry import cents, query


@query("""
WITH p AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS ord FROM events WHERE event_type = 'purchase')
SELECT ord // 32 AS batch_id, CAST(count(*) AS INTEGER) AS size,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
       min(event_id) AS first_event, max(event_id) AS last_event
FROM p GROUP BY 1
""")
def purchase_batches(t):
    purchases = o.filter_rows(t.events, "event_type = 'purchase'")
    return o.summarize_batches(
        purchases, 32, "event_id",
        {"cents": F.sum(cents()), "first_event": F.min("event_id"), "last_event": F.max("event_id")},
    )


@query("SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) + 999 AS place FROM events")
def enumerate_events(t):
    return o.enumerate_rows(t.events, ["ts", "event_id"], start=1000, name="place").select("event_id", "event_type", "place")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 500")
def take_orders(t):
    return o.take(t.orders, 500, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey OFFSET 1000")
def skip_orders(t):
    return o.skip(t.orders, 1000, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("""
SELECT event_id, event_type, value FROM events
WHERE event_id < coalesce((SELECT min(event_id) FROM events WHERE NOT (value <= 400)), 9223372036854775807)
""")
def take_while_events(t):
    return o.take_while(t.events, "value <= 400", "event_id").select("event_id", "event_type", "value")


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS rn FROM orders),
     f AS (SELECT min(rn) AS stop FROM s WHERE NOT (o_totalprice < 250000))
SELECT o_orderkey, o_totalprice FROM s, f WHERE rn < coalesce(stop, 9223372036854775807)
""")
def take_while_orders(t):
    return o.take_while(t.orders, lambda d: d.o_totalprice < 250000, ["o_totalprice", "o_orderkey"]).select(
        "o_orderkey", "o_totalprice")


@query("""
SELECT o_orderkey, o_custkey
FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ord FROM orders) WHERE ord % 8 = 3
""")
def shard_orders(t):
    return o.shard(t.orders, 8, 3, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey")


@query("SELECT CAST(e.range AS INTEGER) AS epoch, c_custkey, c_name FROM customer, range(3) e")
def repeat_customers(t):
    return o.repeat(t.customer, 3).select("epoch", "c_custkey", "c_name")


@query("""
SELECT 0 AS source_id, c_custkey AS key, c_name AS name, c_acctbal AS balance FROM customer
UNION ALL SELECT 1, s_suppkey, s_name, s_acctbal FROM supplier
UNION ALL SELECT 2, p_partkey, p_name, p_retailprice FROM part
""")
def concatenate_parties(t):
    def party(df, *cols):
        return df.select(*[F.col(c).alias(n) for c, n in zip(cols, ("key", "name", "balance"))])

    return o.concatenate(
        party(t.customer, "c_custkey", "c_name", "c_acctbal"),
        party(t.supplier, "s_suppkey", "s_name", "s_acctbal"),
        party(t.part, "p_partkey", "p_name", "p_retailprice"),
    )


@query("""
WITH c AS (SELECT *, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS ord FROM customer),
     p AS (SELECT *, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS ord FROM part)
SELECT c.ord AS ord, c_custkey, p_partkey FROM c JOIN p ON c.ord = p.ord
""")
def zip_customers_parts(t):
    pairs = o.zip_datasets((t.customer, ["c_acctbal", "c_custkey"]), (t.part, ["p_retailprice", "p_partkey"]))
    return pairs.select("ord", F.col("_0.c_custkey").alias("c_custkey"), F.col("_1.p_partkey").alias("p_partkey"))


@query("""
SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS BIGINT) AS net,
       l_returnflag || '/' || l_linestatus AS state
FROM lineitem
""")
def map_lineitem(t):
    return o.map_rows(t.lineitem, {
        "l_orderkey": "l_orderkey",
        "l_linenumber": "l_linenumber",
        "net": F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 10000).cast("bigint"),
        "state": F.concat("l_returnflag", F.lit("/"), "l_linestatus"),
    })


@query("""
SELECT event_id, length(props) AS n, upper(event_type) AS kind FROM events
""")
def map_pandas_events(t):
    def shape(frame):
        return frame.assign(n=frame.props.str.len(), kind=frame.event_type.str.upper())[["event_id", "n", "kind"]]

    return o.map_pandas(t.events.select("event_id", "event_type", "props"), shape, "event_id bigint, n bigint, kind string")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24 AND NOT l_returnflag = 'N'
""")
def filter_lineitem(t):
    kept = o.filter_rows(
        t.lineitem, lambda d: d.l_discount.between(0.05, 0.07) & (d.l_quantity < 24) & ~(d.l_returnflag == "N"))
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("""
WITH w AS (SELECT lang, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos
           FROM documents)
SELECT lang, CAST(length(word) AS INTEGER) AS letters, count(*) AS n, CAST(sum(pos) AS BIGINT) AS places FROM w GROUP BY 1, 2
""")
def flat_map_words(t):
    words = o.flat_map(t.documents.select("lang", "text"), F.split("text", " "), name="word")
    return words.groupBy("lang", F.length("word").alias("letters")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("places"))


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS ord FROM orders)
SELECT ord // 64 AS batch_id, CAST(count(*) AS INTEGER) AS size,
       string_agg(CAST(o_orderkey * 2 AS VARCHAR), ',' ORDER BY ord) AS doubled,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM s GROUP BY 1 HAVING count(*) = 64
""")
def map_and_batch_orders(t):
    batches = o.map_and_batch(
        t.orders,
        {"doubled": F.col("o_orderkey") * 2, "cents": F.round(F.col("o_totalprice") * 100).cast("bigint")},
        64, ["o_orderdate", "o_orderkey"], drop_remainder=True,
    )
    return batches.select(
        "batch_id", "size", F.array_join(F.col("doubled").cast("array<string>"), ",").alias("doubled"),
        F.aggregate("cents", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("cents"))


@query("SELECT o_orderkey AS x0, o_custkey AS x1, o_totalprice AS y FROM orders")
def prepare_orders(t):
    ready = o.prepare(t.orders, "o_totalprice ~ o_orderkey + o_custkey")
    return ready.select(F.get("x", F.lit(0)).alias("x0"), F.get("x", F.lit(1)).alias("x1"), "y")


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS ord FROM orders)
SELECT ord // 100 AS batch_id, CAST(count(*) AS INTEGER) AS size, CAST(sum(o_custkey) AS BIGINT) AS customers,
       string_agg(o_orderstatus, '' ORDER BY ord) AS statuses,
       string_agg(o_orderpriority, ',' ORDER BY ord) AS y
FROM s GROUP BY 1
""")
def prepare_named_batches(t):
    ready = o.prepare(
        t.orders, "o_orderpriority ~ . - o_orderdate - o_totalprice", named_features=True, batch_size=100, order_by="o_orderkey")
    return ready.select(
        "batch_id", "size",
        F.aggregate(F.col("x.o_custkey"), F.lit(0).cast("bigint"), lambda a, b: a + b).alias("customers"),
        F.array_join(F.col("x.o_orderstatus"), "").alias("statuses"), F.array_join("y", ",").alias("y"))


@query("""
WITH k AS (SELECT o_orderkey, nullif(o_custkey % 7, 3) AS part FROM orders)
SELECT o_orderkey, part, row_number() OVER (ORDER BY part NULLS FIRST, o_orderkey) - 1 AS "index" FROM k
""")
def enumerate_nullable(t):
    """Nulls come first."""
    rows = t.orders.select("o_orderkey", F.expr("nullif(o_custkey % 7, 3)").alias("part"))
    return o.enumerate_rows(rows, ["part", "o_orderkey"])


@query("""
WITH k AS (SELECT o_orderkey, nullif(o_custkey % 7, 3) AS part FROM orders),
     r AS (SELECT *, row_number() OVER (ORDER BY part NULLS FIRST, o_orderkey) - 1 AS ord FROM k)
SELECT o_orderkey, part FROM r WHERE ord >= 100
""")
def skip_nullable(t):
    rows = t.orders.select("o_orderkey", F.expr("nullif(o_custkey % 7, 3)").alias("part"))
    return o.skip(rows, 100, ["part", "o_orderkey"])
