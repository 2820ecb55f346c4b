"""Sources and sinks.

The files these queries read are written by Spark from the given tables, into the
shared scratch folder.
"""

from pyspark.sql import functions as F

import ordinate as o
from ordinate.plans.registry import query
from ordinate.scratch import scratch_path

_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders_csv(t, header=True, files=None, **options):
    path = scratch_path(t.spark, "orders-csv")
    rows = t.orders.select(*_ORDERS)
    if files:  # one file per remainder of the key
        rows = rows.withColumn("part", F.col("o_orderkey") % files).repartition(files, "part")
        rows.write.partitionBy("part").options(header=header, **options).csv(path)
        return f"{path}/*/*.csv"
    rows.write.options(header=header, **options).csv(path)
    return path


@query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def delimited_orders(t):
    path = _orders_csv(t)
    spec = o.csv_record_spec(names=_ORDERS, types="iicdc", skip=1)
    return o.text_lines(t.spark, path, spec)


@query("SELECT o_orderkey AS k, CASE WHEN o_custkey % 2 = 0 THEN o_custkey ELSE -7 END AS even, CASE WHEN o_orderstatus = 'F' THEN 'none' ELSE o_orderstatus END AS status FROM orders")
def delimited_defaults(t):
    path = scratch_path(t.spark, "gaps-tsv")
    t.orders.select(
        F.col("o_orderkey"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus"))
    ).write.option("sep", "\t").csv(path)
    spec = o.tsv_record_spec(names=["k", "even", "status"], types=["integer", "integer", "character"], defaults=[0, -7, "none"])
    rows = o.decode_delim(o.text_lines(t.spark, path), spec)
    return rows.select(F.col("k").cast("bigint").alias("k"), F.col("even").cast("bigint").alias("even"), "status")


@query("""
SELECT o_orderkey % 4 AS part, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1 AS line, o_orderkey, o_orderpriority FROM orders
""")
def unpacked_lines(t):
    """Lines of files of which the caller, and not a name, says how they are compressed."""
    path = scratch_path(t.spark, "packed")
    rows = t.orders.select("o_orderkey", "o_orderpriority", (F.col("o_orderkey") % 4).alias("part"))
    rows = rows.repartition(4, "part").sortWithinPartitions("part", "o_orderkey")
    rows.write.partitionBy("part").option("compression", "deflate").csv(path)
    spec = o.csv_record_spec(names=["o_orderkey", "o_orderpriority"], types=["integer", "character"])
    decoded = o.text_lines(t.spark, f"{path}/*/*.csv.deflate", spec, with_position=True, compression="ZLIB")
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint")
    return decoded.select(part.alias("part"), "line", F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority")


@query("""
SELECT o_orderkey % 4 AS part, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) AS line, o_orderkey, o_orderpriority FROM orders
""")
def numbered_lines(t):
    path = scratch_path(t.spark, "lines")
    rows = t.orders.select("o_orderkey", "o_orderpriority", (F.col("o_orderkey") % 4).alias("part"))
    rows = rows.repartition(4, "part").sortWithinPartitions("part", "o_orderkey")
    rows.write.partitionBy("part").option("header", True).csv(path)
    lines = o.text_lines(t.spark, f"{path}/*/*.csv", with_position=True)
    spec = o.csv_record_spec(names=["o_orderkey", "o_orderpriority"], types=["integer", "character"], skip=1)
    part = F.regexp_extract("path", "part=([0-9]+)", 1).cast("bigint")
    decoded = o.decode_delim(lines, spec)
    return decoded.select(part.alias("part"), "line", F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderpriority")


@query("""
WITH s AS (SELECT *, row_number() OVER (ORDER BY CAST(('0x' || substr(md5('3|' || e.range || '|' || o_orderkey), 1, 15)) AS BIGINT), o_orderkey) AS r, e.range AS epoch
           FROM orders, range(2) e),
     p AS (SELECT *, row_number() OVER (ORDER BY epoch, r) - 1 AS ord FROM s)
SELECT ord // 128 AS batch_id, CAST(count(*) AS INTEGER) AS size, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY ord) AS keys,
       CAST(sum(o_custkey) AS BIGINT) AS customers
FROM p GROUP BY 1
""")
def csv_dataset_batches(t):
    batches = o.make_csv_dataset(
        t.spark, _orders_csv(t), batch_size=128, order_by="o_orderkey", label_name="o_custkey",
        select_columns=["o_orderkey", "o_custkey", "o_totalprice"], num_epochs=2, shuffle_seed=3,
    )
    return batches.select(
        "batch_id", "size", F.array_join(F.col("o_orderkey").cast("array<string>"), ",").alias("keys"),
        F.aggregate("o_custkey", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("customers"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority AS label FROM orders")
def csv_dataset_rows(t):
    rows = o.make_csv_dataset(
        t.spark, _orders_csv(t), label_name="o_orderpriority", column_defaults=["integer", -1.0, ""],
        select_columns=["o_orderkey", "o_totalprice", "o_orderpriority"])
    return rows.select(F.col("features.o_orderkey").cast("bigint").alias("o_orderkey"), "features.o_totalprice", "label")


@query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 8 IN (1, 5)")
def sharded_files(t):
    spec = o.csv_record_spec(names=_ORDERS, types="iicdc", skip=1)
    rows = o.read_files(
        t.spark, _orders_csv(t, files=8), lambda spark, paths: o.text_lines(spark, paths, spec), num_shards=4, shard_index=1)
    return rows.select("o_orderkey", "o_orderstatus")


@query("""
WITH k AS (SELECT o_orderkey, o_orderkey % 6 AS part, row_number() OVER (PARTITION BY o_orderkey % 6 ORDER BY o_orderkey) - 1 AS k FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS value, k // 10 AS round, CAST(part AS INTEGER) AS slot, CAST(k % 10 AS INTEGER) AS block_pos FROM k
""")
def interleaved_files(t):
    path = scratch_path(t.spark, "parts")
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("value"), (F.col("o_orderkey") % 6).alias("part"), "o_orderkey")
    rows = rows.repartition(6, "part").sortWithinPartitions("part", "o_orderkey").drop("o_orderkey")
    rows.write.partitionBy("part").text(path)
    turns = o.read_files(
        t.spark, f"{path}/*/*.txt", lambda spark, paths: o.text_lines(spark, paths, with_position=True),
        parallel_files=6, parallel_interleave=10, order_in_file="line")
    return turns.select("value", "round", "slot", "block_pos")


@query("""
WITH k AS (SELECT o_orderkey, o_orderkey % 4 AS part, row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1 AS k FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS value, k // 10 AS round, CAST(CASE part WHEN 3 THEN 0 WHEN 0 THEN 2 WHEN 2 THEN 3 ELSE 4 END AS INTEGER) AS slot,
       CAST(k % 10 AS INTEGER) AS block_pos FROM k
""")
def interleaved_given_files(t):
    """Files in the order of the list, of which the second is empty."""
    path = scratch_path(t.spark, "given")
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("value"), (F.col("o_orderkey") % 4).alias("part"), "o_orderkey")
    rows = rows.repartition(4, "part").sortWithinPartitions("part", "o_orderkey").drop("o_orderkey")
    rows.write.partitionBy("part").text(path)
    t.spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/empty")
    names = [f"{path}/{d}/*.txt" for d in ("part=3", "empty", "part=0", "part=2", "part=1")]
    files = [r.path for name in names for r in o.file_list(t.spark, name, shuffle=False).collect()]
    turns = o.read_files(
        t.spark, files, lambda spark, paths: o.text_lines(spark, paths, with_position=True),
        parallel_files=5, parallel_interleave=10, order_in_file="line")
    return turns.select("value", "round", "slot", "block_pos")


@query("SELECT CAST(o_orderkey % 8 AS INTEGER) AS part, true AS filled FROM orders GROUP BY 1")
def listed_files(t):
    found = o.file_list(t.spark, _orders_csv(t, files=8), shuffle=True, seed=1)
    return found.select(F.regexp_extract("path", "part=([0-9]+)", 1).cast("int").alias("part"), (F.col("length") > 0).alias("filled"))


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS letters, md5(text) AS digest FROM documents")
def framed_documents(t):
    path = scratch_path(t.spark, "framed")
    packed = t.documents.select(F.concat(F.col("doc_id").cast("string"), F.lit("\t"), "text").cast("binary").alias("body"))
    o.write_framed_records(packed, "body", path)
    text = F.col("value").cast("string")
    body = F.expr("substr(cast(value as string), instr(cast(value as string), '\t') + 1)")
    return o.framed_records(t.spark, f"{path}/*.records").select(
        F.substring_index(text, "\t", 1).cast("bigint").alias("doc_id"), F.length(body).alias("letters"), F.md5(body).alias("digest"))


@query("""
SELECT c_custkey, c_nationkey, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS cents, c_custkey % 3 AS n_digits FROM customer
""")
def example_customers(t):
    path = scratch_path(t.spark, "examples")
    features = {"c_custkey": "int64", "c_nationkey": "int64", "c_mktsegment": "bytes", "digits": "int64[]", "balance": "float[]"}
    whole, rest = F.floor("c_acctbal"), F.col("c_acctbal") - F.floor("c_acctbal")  # each exact enough as a float
    rows = t.customer.withColumns({
        "digits": F.slice(F.array(F.lit(1), F.lit(-2), F.lit(3)), F.lit(1), (F.col("c_custkey") % 3).cast("int")),
        "balance": F.array(whole.cast("float"), rest.cast("float"))})
    o.write_framed_records(o.encode_examples(rows, features), "value", path)
    back = o.decode_examples(o.framed_records(t.spark, f"{path}/*.records"), features)
    cents = F.round((F.get("balance", F.lit(0)).cast("double") + F.get("balance", F.lit(1)).cast("double")) * 100).cast("bigint")
    return back.select(
        "c_custkey", F.col("c_nationkey").cast("int").alias("c_nationkey"), F.col("c_mktsegment").cast("string").alias("c_mktsegment"),
        cents.alias("cents"), F.size("digits").cast("bigint").alias("n_digits"))


@query("SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def inferred_orders(t):
    path = _orders_csv(t, sep="\t")
    return o.text_lines(t.spark, path, o.tsv_record_spec(t.spark, path))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def cache_customers(t):
    path = scratch_path(t.spark, "cache")
    return o.cache(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def cache_in_memory(t):
    return o.cache(t.customer.select("c_custkey", "c_name", "c_acctbal"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25")
def collect_cheapest_orders(t):
    rows = o.collect(t.orders.select("o_totalprice", "o_orderkey", "o_custkey"), ["o_totalprice", "o_orderkey"], 25)
    return t.spark.createDataFrame([(r.o_orderkey, r.o_custkey) for r in rows], "o_orderkey bigint, o_custkey bigint")


@query("SELECT max(event_id) AS last_event, count(*) AS n FROM events")
def single_summary(t):
    row = o.single_element(o.reduce_rows(t.events, {"last_event": F.max("event_id"), "n": F.count(F.lit(1))}))
    return t.spark.createDataFrame([tuple(row)], "last_event bigint, n bigint")


@query("""
SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS pos, unnest(list_transform(embedding, lambda v: round(v::DOUBLE * 1000000)))::BIGINT AS millionths
FROM embeddings
""")
def slices_embeddings(t):
    cells = o.unbatch(t.embeddings, "vec_id", ["embedding"])
    return cells.select("vec_id", "pos", F.round(F.col("embedding").cast("double") * 1000000).cast("bigint").alias("millionths"))


@query("SELECT o_orderkey, o_custkey FROM orders")
def fixed_length_orders(t):
    path = scratch_path(t.spark, "fixed")
    fixed = t.orders.select(F.concat(F.lpad(F.col("o_orderkey").cast("string"), 12, "0"), F.lpad(F.col("o_custkey").cast("string"), 11, "0")))
    fixed.write.text(path)  # 23 digits and a line end
    records = o.fixed_length_records(t.spark, f"{path}/part-*", record_bytes=24)
    text = F.col("value").cast("string")
    return records.select(F.substring(text, 1, 12).cast("bigint").alias("o_orderkey"), F.substring(text, 13, 11).cast("bigint").alias("o_custkey"))


@query("""
SELECT CAST(c_nationkey AS INTEGER) AS nation, c_mktsegment AS segment, CAST(count(*) AS BIGINT) AS customers,
       CAST(round(sum(c_acctbal), 2) AS DOUBLE) AS balance FROM customer GROUP BY 1, 2
""")
def sql_customers(t):
    t.customer.createOrReplaceTempView("ordinate_customer")
    spec = o.sql_record_spec(["nation", "segment", "customers", "balance"], ["int32", "string", "int64", "float64"])
    return o.sql_dataset(
        t.spark,
        "SELECT c_nationkey, c_mktsegment, count(*), round(sum(c_acctbal), 2) FROM ordinate_customer GROUP BY 1, 2", spec)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def snapshot_orders(t):
    path = scratch_path(t.spark, "snapshot")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    o.snapshot(rows, path, "GZIP", shard_func=lambda d: d.o_orderkey % 4)
    return o.snapshot(rows, path)  # read from the files


@query("""
WITH e AS (SELECT o_custkey AS "row", CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS col, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT c_custkey AS "row", coalesce(string_agg(col || ':' || n, ',' ORDER BY col), '') AS entries
FROM customer LEFT JOIN e ON e."row" = c_custkey GROUP BY 1
""")
def sparse_customer_priorities(t):
    coo = t.orders.groupBy(F.col("o_custkey").alias("row"), F.substring("o_orderpriority", 1, 1).cast("int").alias("col")).agg(
        F.count(F.lit(1)).alias("value"))
    rows = o.sparse_slices(coo, t.customer.select(F.col("c_custkey").alias("row")))
    entry = F.transform(F.map_entries("entries"), lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string")))
    return rows.select("row", F.array_join(F.array_sort(entry), ",").alias("entries"))


@query("SELECT o_orderkey, 5 + 3 * (row_number() OVER (ORDER BY o_orderkey) - 1) AS value FROM orders")
def range_beside_orders(t):
    n = o.length(t.orders)
    numbers = o.range_dataset(t.spark, 5, 5 + 3 * n, 3)
    pairs = o.zip_datasets((t.orders.select("o_orderkey"), "o_orderkey"), (numbers, "value"))
    return pairs.select("_0.o_orderkey", "_1.value")


@query("""
WITH p AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events),
     h AS (SELECT event_id, pos, CAST(('0x' || substr(md5('13|' || pos || '|low'), 1, 15)) AS BIGINT) AS low,
                  CAST(('0x' || substr(md5('13|' || pos || '|high'), 1, 15)) AS BIGINT) % 16 AS high FROM p)
SELECT event_id, (CASE WHEN high >= 8 THEN high - 16 ELSE high END) * 1152921504606846976 + low AS value FROM h
""")
def random_integers(t):
    """A random number beside each event."""
    numbers = o.random_integer_dataset(t.spark, o.length(t.events), seed=13)
    pairs = o.zip_datasets((t.events.select("event_id"), "event_id"), (numbers, "pos"))
    return pairs.select("_0.event_id", "_1.value")


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 0.5::DOUBLE ELSE o_custkey::DOUBLE END AS customer
FROM orders
""")
def inferred_from_all_rows(t):
    """One value, in the last row, is no whole number."""
    path = scratch_path(t.spark, "odd-csv")
    last = t.orders.agg(F.max("o_orderkey").alias("last"))
    rows = t.orders.join(F.broadcast(last)).select(  # one row
        "o_orderkey", F.when(F.col("o_orderkey") == F.col("last"), "0.5").otherwise(F.col("o_custkey").cast("string")).alias("customer"))
    rows.write.option("header", True).csv(path)
    return o.text_lines(t.spark, path, o.csv_record_spec(t.spark, path))
