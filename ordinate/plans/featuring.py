"""Feature specifications fitted to and applied to whole tables."""

from pyspark.sql import functions as F

from ordinate.features import feature_spec, scaler_min_max, scaler_standard, use_spec
from ordinate.functions import all_nominal, all_numeric, starts_with
from ordinate.plans.registry import query
from ordinate.scratch import scratch_path


def _hash(text: str, n: int) -> str:
    return f"(CAST(('0x' || substr(md5({text}), 1, 15)) AS BIGINT) % {n})"


@query("""
WITH m AS (SELECT avg(c_acctbal) AS mean, stddev_samp(c_acctbal) AS sd, min(c_nationkey) AS lo, max(c_nationkey) AS hi FROM customer)
SELECT c_custkey, round((c_acctbal - mean) / sd, 6) AS balance, round((c_nationkey - lo) / (hi - lo)::DOUBLE, 6) AS nation FROM customer, m
""")
def features_scaled(t):
    spec = (feature_spec(t.customer, ["c_acctbal", "c_nationkey"])
            .step_numeric_column("c_acctbal", normalizer_fn=scaler_standard())
            .step_numeric_column("c_nationkey", normalizer_fn=scaler_min_max())).fit()
    out = use_spec(t.customer, spec, keep=["c_custkey"])
    return out.select("c_custkey", F.round("x.c_acctbal", 6).alias("balance"), F.round("x.c_nationkey", 6).alias("nation"))


@query("""
WITH s AS (SELECT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS id FROM (SELECT DISTINCT c_mktsegment FROM customer)),
     n AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS id FROM (SELECT DISTINCT c_name FROM customer)),
     k AS (SELECT c_nationkey, row_number() OVER (ORDER BY c_nationkey) - 1 AS id FROM (SELECT DISTINCT c_nationkey FROM customer))
SELECT c_custkey, s.id AS segment, n.id AS name, k.id AS nation
FROM customer c JOIN s USING (c_mktsegment) JOIN n USING (c_name) JOIN k USING (c_nationkey)
""")
def features_vocabulary(t):
    spec = feature_spec(t.customer, ["c_mktsegment", "c_name", "c_nationkey"]).step_categorical_column_with_vocabulary_list(
        all_nominal(), "c_nationkey").fit()
    out = use_spec(t.customer, spec, keep=["c_custkey"])
    return out.select("c_custkey", F.col("x.c_mktsegment").alias("segment"), F.col("x.c_name").alias("name"), F.col("x.c_nationkey").alias("nation"))


@query(f"""
SELECT o_orderkey,
       CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '1-URGENT' THEN 1 ELSE 2 + {_hash('o_orderpriority', 3)} END AS BIGINT) AS priority,
       CAST(CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 9 END AS BIGINT) AS status
FROM orders
""")
def features_given_vocabulary(t):
    spec = (feature_spec(t.orders, ["o_orderpriority", "o_orderstatus"])
            .step_categorical_column_with_vocabulary_list("o_orderpriority", vocabulary_list=["5-LOW", "1-URGENT"], num_oov_buckets=3)
            .step_categorical_column_with_vocabulary_list("o_orderstatus", vocabulary_list=["P", "O"], default_value=9)).fit()
    out = use_spec(t.orders, spec, keep=["o_orderkey"])
    return out.select("o_orderkey", F.col("x.o_orderpriority").alias("priority"), F.col("x.o_orderstatus").alias("status"))


@query("""
WITH b AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand DESC) - 1 AS id FROM (SELECT DISTINCT p_brand FROM part))
SELECT p_partkey, CASE WHEN id < 10 THEN id ELSE -1 END AS brand FROM part JOIN b USING (p_brand)
""")
def features_vocabulary_file(t):
    path = scratch_path(t.spark, "brands")
    t.part.select("p_brand").distinct().coalesce(1).sortWithinPartitions(F.desc("p_brand")).write.text(path)
    spec = feature_spec(t.part, ["p_brand"]).step_categorical_column_with_vocabulary_file(
        "p_brand", vocabulary_file=path, vocabulary_size=10).fit()
    return use_spec(t.part, spec, keep=["p_partkey"]).select("p_partkey", F.col("x.p_brand").alias("brand"))


@query(f"""
SELECT c_custkey, {_hash('c_name', 100)} AS name, CAST(CASE WHEN c_nationkey < 20 THEN c_nationkey ELSE 0 END AS BIGINT) AS nation FROM customer
""")
def features_hash_and_identity(t):
    spec = (feature_spec(t.customer, ["c_name", "c_nationkey"])
            .step_categorical_column_with_hash_bucket("c_name", hash_bucket_size=100)
            .step_categorical_column_with_identity("c_nationkey", num_buckets=20, default_value=0)).fit()
    out = use_spec(t.customer, spec, keep=["c_custkey"])
    return out.select("c_custkey", F.col("x.c_name").alias("name"), F.col("x.c_nationkey").alias("nation"))


@query(f"""
WITH s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS id FROM (SELECT DISTINCT c_mktsegment FROM customer)),
     b AS (SELECT c.*, CAST(s.id AS VARCHAR) AS seg,
                  CAST((c_acctbal >= -500)::INT + (c_acctbal >= 0)::INT + (c_acctbal >= 2500)::INT + (c_acctbal >= 7500)::INT AS INTEGER) AS bucket
           FROM customer c JOIN s USING (c_mktsegment)),
     x AS (SELECT *, length(seg) || ':' || seg || chr(31) || length(CAST(bucket AS VARCHAR)) || ':' || bucket AS pair,
                  '2:17' || chr(31) || length(CAST(bucket AS VARCHAR)) || ':' || bucket || chr(31) || length(CAST(c_nationkey AS VARCHAR)) || ':' || c_nationkey AS keyed FROM b)
SELECT c_custkey, bucket, {_hash('pair', 50)} AS crossed, {_hash('keyed', 1000)} AS crossed_keyed FROM x
""")
def features_bucketized_and_crossed(t):
    spec = (feature_spec(t.customer, ["c_acctbal", "c_mktsegment", "c_nationkey"])
            .step_numeric_column("c_acctbal", dtype="double")
            .step_categorical_column_with_vocabulary_list("c_mktsegment")
            .step_bucketized_column(bucket="c_acctbal", boundaries=[-500, 0, 2500, 7500])
            .step_crossed_column(["c_mktsegment", "bucket"], hash_bucket_size=50)
            .step_crossed_column(hash_bucket_size=1000, hash_key=17, keyed=["bucket", "c_nationkey"])
            .step_remove_column("c_acctbal")).fit()
    out = use_spec(t.customer, spec, keep=["c_custkey"])
    return out.select("c_custkey", "x.bucket", F.col("x.crossed_c_mktsegment_bucket").alias("crossed"), F.col("x.keyed").alias("crossed_keyed"))


@query("""
WITH s AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS id FROM (SELECT DISTINCT o_orderpriority FROM orders))
SELECT o_orderkey, array_to_string(list_transform(range(5), lambda i: CASE WHEN i = id THEN 1 ELSE 0 END), '') AS one_hot,
       CAST(id AS INTEGER) AS sparse_index
FROM orders JOIN s USING (o_orderpriority)
""")
def features_indicator(t):
    spec = (feature_spec(t.orders, ["o_orderpriority"])
            .step_categorical_column_with_vocabulary_list("o_orderpriority")
            .step_indicator_column("o_orderpriority")
            .step_indicator_column(sparse=True, wide="o_orderpriority")).fit()
    out = use_spec(t.orders, spec, keep=["o_orderkey"])
    one_hot = F.array_join(F.col("x.indicator_o_orderpriority").cast("array<int>").cast("array<string>"), "")
    return out.select("o_orderkey", one_hot.alias("one_hot"), F.get("x.wide.indices", F.lit(0)).alias("sparse_index"))


@query("""
WITH j AS (SELECT o.*, c_acctbal, c_mktsegment FROM orders o JOIN customer c ON o_custkey = c_custkey),
     m AS (SELECT avg(o_totalprice) AS pm, stddev_samp(o_totalprice) AS ps, avg(c_acctbal) AS bm, stddev_samp(c_acctbal) AS bs FROM j),
     s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS id FROM (SELECT DISTINCT c_mktsegment FROM j)),
     x AS (SELECT o_orderkey, o_orderstatus AS y, list_concat(
             [round((o_totalprice - pm) / ps, 5), round((c_acctbal - bm) / bs, 5)],
             list_transform(range(5), lambda i: CASE WHEN i = id THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END),
             list_transform(range(4), lambda i: CASE WHEN i = ((c_acctbal - bm) / bs >= -1)::INT + ((c_acctbal - bm) / bs >= 0)::INT + ((c_acctbal - bm) / bs >= 1)::INT
                                               THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)) AS x
           FROM j JOIN s USING (c_mktsegment), m)
SELECT o_orderkey, y, len(x) AS width, x[1] AS price, x[2] AS balance, CAST(list_position(x[3:7], 1.0) AS BIGINT) AS segment, CAST(list_position(x[8:11], 1.0) AS BIGINT) AS bucket FROM x
""")
def features_dense(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    spec = (feature_spec(joined, "o_orderstatus ~ o_totalprice + c_acctbal + c_mktsegment")
            .step_numeric_column(all_numeric(), normalizer_fn=scaler_standard())
            .step_categorical_column_with_vocabulary_list(starts_with("c_mkt"))
            .step_indicator_column("c_mktsegment")
            .step_bucketized_column("c_acctbal", boundaries=[-1, 0, 1])).fit()
    out = use_spec(joined, spec, keep=["o_orderkey"], dense=True)
    return out.select(
        "o_orderkey", "y", F.size("x").cast("bigint").alias("width"), F.round(F.get("x", F.lit(0)), 5).alias("price"),
        F.round(F.get("x", F.lit(1)), 5).alias("balance"),
        F.array_position(F.slice("x", 3, 5), 1.0).alias("segment"), F.array_position(F.slice("x", 8, 4), 1.0).alias("bucket"))


def _digest(vector):
    """All components in millionths, as one digest."""
    return F.md5(F.array_join(F.transform(vector, lambda v: F.round(v * 1000000).cast("bigint").cast("string")), ","))


_DIGEST = "md5(array_to_string(list_transform(%s, lambda a: CAST(CAST(round(a * 1000000) AS BIGINT) AS VARCHAR)), ','))"
_ZEROS = "list_transform(range(64), lambda i: 0.0::DOUBLE)"


def _vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query(f"""
WITH w AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS v FROM embeddings),
     n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda a: a * a))) AS norm FROM w),
     c AS (SELECT vec_id, CASE WHEN norm > 0.9 THEN list_transform(v, lambda a: a * 0.9 / norm) ELSE v END AS v FROM n)
SELECT o_orderkey, {_DIGEST % f"coalesce(v, {_ZEROS})"} AS vector
FROM orders LEFT JOIN c ON vec_id = CASE WHEN o_custkey < 600 THEN o_custkey ELSE 599 END
""")
def features_embedding(t):
    spec = (feature_spec(t.orders, ["o_custkey"])
            .step_categorical_column_with_identity("o_custkey", num_buckets=600, default_value=599)
            .step_embedding_column("o_custkey", dimension=64, max_norm=0.9, weights=_vectors(t))).fit()
    out = use_spec(t.orders, spec, keep=["o_orderkey"])
    return out.select("o_orderkey", _digest(F.col("x.embedding_o_custkey")).alias("vector"))


@query(f"""
WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations),
     i AS (SELECT conv_id, turn, {_hash('word', 400)} AS id FROM w),
     n AS (SELECT conv_id, turn, count(*) AS n FROM i JOIN embeddings ON vec_id = id GROUP BY 1, 2),
     p AS (SELECT conv_id, turn, d, sum(embedding[d]::DOUBLE) AS s FROM i JOIN embeddings ON vec_id = id, range(1, 65) r(d) GROUP BY 1, 2, 3),
     v AS (SELECT conv_id, turn, list(s / sqrt(n) ORDER BY d) AS v FROM p JOIN n USING (conv_id, turn) GROUP BY 1, 2)
SELECT conv_id, turn, {_DIGEST % f"coalesce(v, {_ZEROS})"} AS vector FROM conversations LEFT JOIN v USING (conv_id, turn)
""")
def features_embedding_words(t):
    words = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("words"))
    spec = (feature_spec(words, ["words"])
            .step_categorical_column_with_hash_bucket("words", hash_bucket_size=400)
            .step_embedding_column("words", dimension=64, combiner="sqrtn", weights=_vectors(t))
            .step_remove_column("words")).fit()
    out = use_spec(words, spec, keep=["conv_id", "turn"])
    return out.select("conv_id", "turn", _digest(F.col("x.embedding_words")).alias("vector"))


@query("""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS words FROM conversations),
     i AS (SELECT conv_id, turn, unnest(words) AS word, unnest(range(len(words))) AS pos FROM w),
     v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS id FROM (SELECT DISTINCT word FROM i))
SELECT conv_id, turn, string_agg(id, ',' ORDER BY pos) AS ids FROM i JOIN v USING (word) GROUP BY 1, 2
""")
def features_vocabulary_of_arrays(t):
    words = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("words"))
    spec = feature_spec(words, ["words"]).step_categorical_column_with_vocabulary_list("words").fit()
    out = use_spec(words, spec, keep=["conv_id", "turn"])
    return out.select("conv_id", "turn", F.array_join(F.col("x.words").cast("array<string>"), ",").alias("ids"))


@query("""
WITH w AS (SELECT doc_id, string_split(text, ' ') AS words FROM documents),
     i AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM w),
     v AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS id FROM (SELECT DISTINCT word FROM i))
SELECT doc_id, count(*) AS items, md5(string_agg(id, ',' ORDER BY pos)) AS ids FROM i JOIN v USING (word) GROUP BY 1
""")
def features_vocabulary_of_documents(t):
    """Words of whole documents, however long."""
    words = t.documents.select("doc_id", F.split("text", " ").alias("words"))
    spec = feature_spec(words, ["words"]).step_categorical_column_with_vocabulary_list("words").fit()
    out = use_spec(words, spec, keep=["doc_id"])
    ids = F.col("x.words")
    return out.select("doc_id", F.size(ids).cast("bigint").alias("items"), F.md5(F.array_join(ids.cast("array<string>"), ",")).alias("ids"))


@query(f"""
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
     n AS (SELECT doc_id, {_hash('word', 1000)} AS id, count(*) AS n FROM w GROUP BY 1, 2),
     p AS (SELECT doc_id, sum(n * floor(embedding[1]::DOUBLE * 1024)) AS s, sum(n) AS n FROM n JOIN embeddings ON vec_id = id GROUP BY 1)
SELECT doc_id, (SELECT count(*) FROM n WHERE n.doc_id = d.doc_id) AS different, (SELECT max(n) FROM n WHERE n.doc_id = d.doc_id) AS most,
       coalesce(s / n, 0) AS mean
FROM documents d LEFT JOIN p USING (doc_id)
""")
def features_counts_of_documents(t):
    """How often words of whole documents occur, and the mean of their vectors (of whole numbers, which add up exactly)."""
    words = t.documents.select("doc_id", F.split("text", " ").alias("words"))
    whole = t.embeddings.select(F.col("vec_id").alias("id"), F.array(F.floor(F.get("embedding", F.lit(0)).cast("double") * 1024)).alias("vector"))
    spec = (feature_spec(words, ["words"])
            .step_categorical_column_with_hash_bucket("words", hash_bucket_size=1000)
            .step_indicator_column(sparse=True, counts="words")
            .step_embedding_column("words", dimension=1, combiner="mean", weights=whole)
            .step_remove_column("words")).fit()
    out = use_spec(words, spec, keep=["doc_id"])
    return out.select("doc_id", F.size("x.counts.indices").cast("bigint").alias("different"),
                      F.array_max("x.counts.values").cast("bigint").alias("most"), F.get("x.embedding_words", F.lit(0)).alias("mean"))


@query(f"""
WITH w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations),
     n AS (SELECT conv_id, turn, {_hash('word', 16)} AS id, count(*) AS n FROM w GROUP BY 1, 2, 3),
     a AS (SELECT conv_id, turn, i, coalesce(n, 0) AS n FROM (SELECT conv_id, turn, i FROM conversations, range(16) r(i)) LEFT JOIN (SELECT conv_id, turn, id AS i, n FROM n) USING (conv_id, turn, i))
SELECT conv_id, turn, string_agg(n, ',' ORDER BY i) AS counts FROM a GROUP BY 1, 2
""")
def features_multi_hot(t):
    words = t.conversations.select("conv_id", "turn", F.split("text", " ").alias("words"))
    spec = (feature_spec(words, ["words"])
            .step_categorical_column_with_hash_bucket("words", hash_bucket_size=16)
            .step_indicator_column("words")).fit()
    out = use_spec(words, spec, keep=["conv_id", "turn"])
    counts = F.col("x.indicator_words").cast("array<int>").cast("array<string>")
    return out.select("conv_id", "turn", F.array_join(counts, ",").alias("counts"))


@query("""
SELECT o_orderkey,
       CAST(CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 3 ELSE -1 END AS BIGINT) AS priority,
       CAST(CASE o_custkey WHEN 7 THEN 0 WHEN 3 THEN 2 ELSE -1 END AS BIGINT) AS customer
FROM orders
""")
def features_repeated_vocabulary(t):
    """An entry that is there twice has the id of its first place; 7.0 is 7."""
    rows = t.orders.withColumn("customer", F.col("o_custkey").cast("double"))
    spec = (feature_spec(rows, ["o_orderpriority", "customer"])
            .step_categorical_column_with_vocabulary_list("o_orderpriority", vocabulary_list=["5-LOW", "1-URGENT", "5-LOW", "2-HIGH"])
            .step_categorical_column_with_vocabulary_list("customer", vocabulary_list=[7, 7.0, 3])).fit()
    out = use_spec(rows, spec, keep=["o_orderkey"])
    return out.select("o_orderkey", F.col("x.o_orderpriority").alias("priority"), F.col("x.customer").alias("customer"))


_SUM = "CAST(list_sum(list_transform(%s, lambda v, i: CAST(floor(v::DOUBLE * 1000000 + 0.5) AS BIGINT) * i)) AS BIGINT)"


def _sum(vector):
    """All components in millionths, each times its place, added up: a check of every one that costs little."""
    terms = F.transform(vector, lambda v, i: F.floor(v * 1000000 + 0.5) * (i + 1))
    return F.aggregate(terms, F.lit(0).cast("bigint"), lambda total, v: total + v)


@query(f"""
WITH i AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_partkey % 500 AS p, l_suppkey % 500 AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, {_SUM % "a.embedding"} AS part, {_SUM % "b.embedding"} AS supplier
FROM i JOIN embeddings a ON a.vec_id = p JOIN embeddings b ON b.vec_id = s
""")
def features_shared_embeddings(t):
    items = t.lineitem.withColumns({"p": F.col("l_partkey") % 500, "s": F.col("l_suppkey") % 500})
    spec = (feature_spec(items, ["p", "s"])
            .step_categorical_column_with_identity("p", "s", num_buckets=500)
            .step_shared_embeddings_column("p", "s", dimension=64, weights=_vectors(t))).fit()
    out = use_spec(items, spec, keep=["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])
    vector = lambda c: _sum(F.col(f"x.shared_embeddings_p_s_{c}"))
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", vector("p").alias("part"), vector("s").alias("supplier"))
