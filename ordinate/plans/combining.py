"""Several sequences made into one, and new orders for one."""

from pyspark.sql import functions as F

import ordinate as o
from ordinate.plans.registry import query


def segments(t):
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return [(rows.where(F.col("c_mktsegment") == s), "c_custkey") for s in ("BUILDING", "MACHINERY", "HOUSEHOLD", "AUTOMOBILE", "FURNITURE")]


_CHOSEN = """
WITH c AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS step, CAST(o_custkey % 5 AS INTEGER) AS source_id FROM orders),
     k AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY step) - 1 AS k FROM c),
     s AS (SELECT *, CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 WHEN 'HOUSEHOLD' THEN 2
                            WHEN 'AUTOMOBILE' THEN 3 WHEN 'FURNITURE' THEN 4 END AS source_id FROM customer),
     p AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY c_custkey) - 1 AS k FROM s WHERE source_id IS NOT NULL),
     j AS (SELECT k.step, k.source_id, p.c_custkey, p.c_name FROM k LEFT JOIN p ON k.source_id = p.source_id AND k.k = p.k)
"""


@query(_CHOSEN + """
SELECT * FROM j WHERE step < coalesce((SELECT min(step) FROM j WHERE c_custkey IS NULL), 9223372036854775807)
""")
def choose_until_empty(t):
    choices = t.orders.select("o_orderkey", (F.col("o_custkey") % 5).alias("choice"))
    return o.choose_from_datasets(segments(t), choices, "choice", "o_orderkey").drop("c_mktsegment")


@query(_CHOSEN + "SELECT * FROM j WHERE c_custkey IS NOT NULL")
def choose_all(t):
    choices = t.orders.select("o_orderkey", (F.col("o_custkey") % 5).alias("choice"))
    picked = o.choose_from_datasets(segments(t), choices, "choice", "o_orderkey", stop_on_empty=False)
    return picked.drop("c_mktsegment")


def parties(t):
    return [
        (t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")), "key"),
        (t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")), "key"),
        (t.part.select(F.col("p_partkey").alias("key"), F.col("p_name").alias("name")), "key"),
    ]


_WAIT = """CAST(floor(-ln(1.0 - CAST(('0x' || substr(md5('%d|' || %s), 1, 15)) AS BIGINT) / 1152921504606846976.0::DOUBLE)
           / %s::DOUBLE * 1000000.0::DOUBLE) AS BIGINT)"""

_SAMPLED = f"""
WITH s AS (SELECT 0 AS source_id, c_custkey AS key, c_name AS name, 0.5 AS w FROM customer
           UNION ALL SELECT 1, s_suppkey, s_name, 0.2 FROM supplier
           UNION ALL SELECT 2, p_partkey, p_name, 0.3 FROM part),
     a AS (SELECT *, {_WAIT % (5, "source_id || '|' || key", "w")} AS wait FROM s),
     r AS (SELECT source_id, key, name, CAST(sum(wait) OVER o AS BIGINT) AS arrival, row_number() OVER o - 1 AS source_pos
           FROM a WINDOW o AS (PARTITION BY source_id ORDER BY key)),
     e AS (SELECT min(total + {_WAIT % (5, "source_id || '|end'", "w")}) AS stop
           FROM (SELECT source_id, any_value(w) AS w, sum(wait) AS total FROM a GROUP BY 1))
"""


@query(_SAMPLED + "SELECT arrival, source_id, source_pos, key, name FROM r, e WHERE arrival < stop")
def sample_until_empty(t):
    return o.sample_from_datasets(parties(t), seed=5, weights=[0.5, 0.2, 0.3])


@query(_SAMPLED + "SELECT arrival, source_id, source_pos, key, name FROM r")
def sample_all(t):
    return o.sample_from_datasets(parties(t), seed=5, weights=[0.5, 0.2, 0.3], stop_on_empty=False)


@query(_SAMPLED + "SELECT arrival, source_id, source_pos, key, name FROM r")
def sample_large_weights(t):
    """Only the ratios of weights count."""
    return o.sample_from_datasets(parties(t), seed=5, weights=[5e8, 2e8, 3e8], stop_on_empty=False)


@query("""
WITH w AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS step, o_custkey % 4 + 1 AS a, o_custkey % 3 AS b, o_custkey % 5 AS c FROM orders),
     u AS (SELECT *, CAST(('0x' || substr(md5('9|' || step), 1, 15)) AS BIGINT) / 1152921504606846976.0::DOUBLE * (a + b + c) AS point FROM w),
     d AS (SELECT step, CASE WHEN point >= a + b THEN 2 WHEN point >= a THEN 1 ELSE 0 END AS source_id FROM u),
     k AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY step) - 1 AS k FROM d),
     s AS (SELECT 0 AS source_id, c_custkey AS key, c_name AS name FROM customer
           UNION ALL SELECT 1, s_suppkey, s_name FROM supplier UNION ALL SELECT 2, p_partkey, p_name FROM part),
     p AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY key) - 1 AS k FROM s)
SELECT k.step, k.source_id, p.key, p.name FROM k JOIN p ON k.source_id = p.source_id AND k.k = p.k
""")
def sample_varying_weights(t):
    c = F.col("o_custkey")
    weights = t.orders.select("o_orderkey", F.array(c % 4 + 1, c % 3, c % 5).cast("array<double>").alias("weights"))
    return o.sample_from_datasets(
        parties(t), seed=9, weights=weights, weights_order="o_orderkey", stop_on_empty=False)


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY CAST(('0x' || substr(md5('42|' || o_orderkey), 1, 15)) AS BIGINT), o_orderkey) - 1 AS place
FROM orders
""")
def shuffle_orders(t):
    mixed = o.shuffle(t.orders.select("o_orderkey"), "o_orderkey", seed=42)
    return o.enumerate_rows(mixed, ["shuffle_key", "o_orderkey"], name="place").select("o_orderkey", "place")


@query("""
WITH s AS (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS block,
                  CAST(('0x' || substr(md5('42|' || event_id), 1, 15)) AS BIGINT) AS h FROM events)
SELECT event_id, row_number() OVER (ORDER BY block, h, event_id) - 1 AS place FROM s
""")
def shuffle_event_blocks(t):
    mixed = o.shuffle(t.events.select("event_id"), "event_id", seed=42, buffer_size=1000)
    order = ["shuffle_key_block", "shuffle_key", "event_id"]
    return o.enumerate_rows(mixed, order, name="place").select("event_id", "place")


@query("""
WITH s AS (SELECT c_custkey, CAST(e.range AS INTEGER) AS epoch,
                  CAST(('0x' || substr(md5('7|' || e.range || '|' || c_custkey), 1, 15)) AS BIGINT) AS h FROM customer, range(3) e)
SELECT epoch, c_custkey, row_number() OVER (ORDER BY epoch, h, c_custkey) - 1 AS place FROM s
""")
def shuffle_and_repeat_customers(t):
    mixed = o.shuffle_and_repeat(t.customer.select("c_custkey"), "c_custkey", 3, seed=7)
    return o.enumerate_rows(mixed, ["epoch", "shuffle_key", "c_custkey"], name="place").select("epoch", "c_custkey", "place")


def _interleaved(source: str, cycle: int, block: int) -> str:
    """Sources are opened one by one: each takes the slot that is free first."""
    return f"""
WITH RECURSIVE k AS (SELECT event_id, {source} AS source, row_number() OVER (PARTITION BY {source} ORDER BY event_id) - 1 AS k FROM events),
n AS (SELECT source, count(*) // {block} + 1 AS turns, row_number() OVER (ORDER BY source) AS i FROM k GROUP BY 1),
plan(i, free, slot, first_round) AS (
  SELECT CAST(0 AS BIGINT), list_resize([CAST(0 AS BIGINT)], {cycle}, CAST(0 AS BIGINT)), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  UNION ALL
  SELECT n.i, list_transform(p.free, lambda f, j: CASE WHEN j = list_position(p.free, list_min(p.free)) THEN f + n.turns ELSE f END),
         CAST(list_position(p.free, list_min(p.free)) - 1 AS BIGINT), list_min(p.free)
  FROM plan p JOIN n ON n.i = p.i + 1)
SELECT event_id, first_round + k // {block} AS round, CAST(slot AS INTEGER) AS slot, CAST(k % {block} AS INTEGER) AS block_pos
FROM k JOIN n ON k.source = n.source JOIN plan ON plan.i = n.i
"""


@query(_interleaved("event_type", 3, 4))
def interleave_types(t):
    turns = o.interleave(t.events.select("event_id", "event_type"), "event_type", "event_id", cycle_length=3, block_length=4)
    return turns.drop("event_type")


@query(_interleaved("user_id", 8, 16))
def interleave_users(t):
    turns = o.interleave(t.events.select("event_id", "user_id"), "user_id", "event_id", cycle_length=8, block_length=16)
    return turns.drop("user_id")
