"""Aggregates, folds, scans, distinct rows, resampling, sizes."""

from pyspark.sql import functions as F

import ordinate as o
from ordinate.plans.registry import cents, query


@query("""
SELECT count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity,
       CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
       round(avg(l_discount), 6) AS discount, min(l_orderkey) AS lo, max(l_orderkey) AS hi
FROM lineitem
""")
def reduce_lineitem(t):
    return o.reduce_rows(t.lineitem, {
        "n": F.count(F.lit(1)),
        "quantity": F.sum("l_quantity").cast("bigint"),
        "cents": F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")),
        "discount": F.round(F.avg("l_discount"), 6),
        "lo": F.min("l_orderkey"),
        "hi": F.max("l_orderkey"),
    })


@query("""
WITH s AS (SELECT event_id, CASE WHEN value > lag(value) OVER (ORDER BY event_id) THEN 0 ELSE 1 END AS fresh FROM events),
     r AS (SELECT sum(fresh) OVER (ORDER BY event_id) AS run FROM s), c AS (SELECT run, count(*) AS n FROM r GROUP BY 1)
SELECT max(n) AS longest, (SELECT count(*) FROM c) AS runs FROM c
""")
def fold_longest_rise(t):
    """Length of the longest strictly rising run of values, and the number of runs."""

    def merge(a, b):
        if a is None or b is None:
            return a if b is None else b
        joins = b["first"] > a["last"]
        middle = a["tail"] + b["head"] if joins else 0
        return {
            "first": a["first"], "last": b["last"], "n": a["n"] + b["n"],
            "head": a["n"] + b["head"] if joins and a["head"] == a["n"] else a["head"],
            "tail": b["n"] + a["tail"] if joins and b["tail"] == b["n"] else b["tail"],
            "best": max(a["best"], b["best"], middle), "runs": a["runs"] + b["runs"] - joins,
        }

    def step(state, frame):
        runs = (~(frame.value > frame.value.shift())).cumsum()
        sizes = runs.value_counts(sort=False)
        part = {
            "first": frame.value.iloc[0], "last": frame.value.iloc[-1], "n": len(frame),
            "head": int(sizes.loc[runs.iloc[0]]), "tail": int(sizes.loc[runs.iloc[-1]]),
            "best": int(sizes.max()), "runs": len(sizes),
        }
        return merge(state, part)

    found = o.fold_rows(t.events.select("event_id", "value"), "event_id", None, step, merge)
    return t.spark.createDataFrame([(int(found["best"]), int(found["runs"]))], "longest bigint, runs bigint")


@query("""
SELECT CAST(1000000 + sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, least(-5.0::DOUBLE, min(value)) AS lowest,
       greatest(0.5::DOUBLE, max(value)) AS highest FROM events
""")
def reduce_from_start(t):
    return o.reduce_rows(
        t.events, {"cents": F.sum(cents()), "lowest": F.min("value"), "highest": F.max("value")},
        initial={"cents": ("sum", 1000000), "lowest": ("min", -5.0), "highest": ("max", 0.5)})


def _add_cents(total, frame):
    return total + int((frame.value * 100).round().astype("int64").sum())


@query("SELECT CAST(777 + sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events")
def fold_from_start(t):
    total = o.fold_rows(t.events.select("event_id", "value"), "event_id", 777, _add_cents, lambda a, b: a + b, zero=0)
    return t.spark.createDataFrame([(total,)], "cents bigint")


@query("""
SELECT event_id, CAST(777 + sum(CAST(round(value * 100) AS BIGINT)) OVER (ORDER BY event_id) AS BIGINT) AS cents FROM events
""")
def scan_from_start(t):
    def emit(total, frame):
        running = (frame.value * 100).round().astype("int64").cumsum() + total
        return int(running.iloc[-1]), frame[["event_id"]].assign(cents=running)

    return o.scan_rows(
        t.events.select("event_id", "value"), "event_id", 777, _add_cents, lambda a, b: a + b, emit, "event_id bigint, cents bigint", zero=0)


@query("""
SELECT event_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents, min(value) OVER w AS lowest,
       max(value) OVER w AS highest, count(value) OVER w AS n
FROM events WINDOW w AS (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def scan_events(t):
    v = F.col("value")
    totals = {"cents": ("sum", cents()), "lowest": ("min", v), "highest": ("max", v), "n": ("count", v)}
    return o.scan(t.events, "event_id", totals).select("event_id", *totals)


@query("""
SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents_before, count(value) OVER w AS n_before
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def scan_users(t):
    totals = {"cents_before": ("sum", cents()), "n_before": ("count", F.col("value"))}
    return o.scan(t.events, ["ts", "event_id"], totals, "user_id", exclusive=True).select("event_id", "user_id", *totals)


@query("""
WITH g AS (SELECT event_id, event_type, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (ORDER BY event_id) AS grp FROM events)
SELECT event_id, row_number() OVER (PARTITION BY grp ORDER BY event_id) - CASE WHEN grp > 0 THEN 1 ELSE 0 END AS since
FROM g
""")
def scan_since_purchase(t):
    """Events since the latest purchase, or since the beginning."""

    def counts(state, frame):
        bought = frame.event_type == "purchase"
        group = bought.cumsum()
        place = bought.groupby(group).cumcount()
        since = place.where(group > 0, place + 1 + state[1])
        return since, (state[0] or bool(bought.any()), int(since.iloc[-1]))

    def step(state, frame):
        return counts(state, frame)[1]

    def merge(a, b):  # (has a purchase been seen, events since it)
        return b if b[0] else (a[0], a[1] + b[1])

    def emit(state, frame):
        since, state = counts(state, frame)
        return state, frame[["event_id"]].assign(since=since)

    return o.scan_rows(
        t.events.select("event_id", "event_type"), "event_id", (False, 0), step, merge, emit, "event_id bigint, since bigint")


@query("SELECT DISTINCT user_id, event_type FROM events")
def unique_user_types(t):
    return o.unique(t.events.select("user_id", "event_type"))


@query("""
SELECT event_id, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def unique_first_events(t):
    return o.unique(t.events, ["user_id", "event_type"], order_by="event_id").select("event_id", "user_id", "event_type", "value")


@query("""
WITH n AS (SELECT quality, count(*) / (SELECT count(*) FROM labels) AS share FROM labels GROUP BY 1),
     r AS (SELECT quality, 0.5 / share AS ratio FROM n)
SELECT l.quality AS class_id, doc_id, toxic FROM labels l JOIN r ON l.quality = r.quality
WHERE CAST(('0x' || substr(md5('11|' || doc_id), 1, 15)) AS BIGINT) / 1152921504606846976.0::DOUBLE < ratio / (SELECT max(ratio) FROM r)
""")
def resample_labels(t):
    even = o.rejection_resample(t.labels, "quality", [0.5, 0.5], seed=11, order_by="doc_id")
    return even.select("class_id", "doc_id", "toxic")


@query("""
SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'benchmark', count(*) FROM benchmark
""")
def lengths(t):
    names = ["orders", "documents", "pages", "benchmark"]
    return t.spark.createDataFrame([(n, o.length(getattr(t, n))) for n in names], "name string, n bigint")


@query("""
SELECT 'vec_id' AS "column", 0 AS rank, CAST(NULL AS INTEGER) AS min_length, CAST(NULL AS INTEGER) AS max_length
UNION ALL SELECT 'embedding', 1, CAST(min(len(embedding)) AS INTEGER), CAST(max(len(embedding)) AS INTEGER) FROM embeddings
UNION ALL SELECT 'label', 0, NULL, NULL
""")
def shapes_embeddings(t):
    return o.output_shapes(t.embeddings)
