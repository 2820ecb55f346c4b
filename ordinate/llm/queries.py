"""One query for each operator, on its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordinate.llm import (
    bpe, credentials, infill, packing, quality, repeats, sharding, simhash, spelling, token_counts, topk, vectors, warc)
from ordinate.llm.common import table

#: The shards that documents are dealt to: two regions of two racks of four.
TREE = sharding.even_tree(2, 2, 4)
#: Scores from here on count as good.
GOOD = 0.7


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that chains of SimHashes within three bits connect."""
    rows = simhash.simhash_groups(table(spark, folder, "documents"))
    return rows.select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in 16 shards of a weighted hash tree."""
    rows = sharding.shards(table(spark, folder, "documents"), TREE)
    return rows.select(
        F.col("key").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, with those that only their neighbours make credentials."""
    kinds = credentials.KINDS
    rows = credentials.credentials(table(spark, folder, "documents"))
    names = F.array(*[F.lit(k.name) for k in kinds])
    base = F.filter("spans", lambda s: s["number"] < len(credentials.BASE))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["number"] + 1), s["start"], s["stop"])), ",")

    def count(number):
        return F.size(F.filter("spans", lambda s: s["number"] == number)).cast("long")  # (a second argument would be the place)

    counts = [count(number).alias(f"n_{name}") for number, name in enumerate(credentials.BASE)]
    return rows.select(F.col("key").alias("doc_id"), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, and the text decoded from them."""
    rows = bpe.encode_texts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), ids=False)
    return rows.withColumnRenamed("key", "doc_id")


def op5_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.93 or more, and their components."""
    rows = vectors.vector_groups(table(spark, folder, "embeddings"), 0.93)
    return rows.select(
        F.col("key").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
        (F.col("key") == F.col("component")).alias("kept"), F.col("recall").alias("audited_recall"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learnt from the labels that are not held out."""
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    rows = quality.score(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents cut into sequences of 2048 tokens."""
    rows = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return rows.withColumnRenamed("key", "doc_id")


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the strings of 200 bytes that occur more than once."""
    return repeats.without_repeats(table(spark, folder, "documents")).drop("mark").withColumnRenamed("key", "doc_id")


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector, in whole numbers."""
    good = table(spark, folder, "embeddings").where(topk.usable(F.col("embedding")))  # before floor() makes numbers of NaN
    rows = good.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("embedding"))
    found = topk.search(rows.where("vec_id % 50 = 0"), rows, 5)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("vec").alias("vec_id"), "score")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages in a content-addressed archive, as read back from it."""
    return warc.archived(table(spark, folder, "pages")).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents with the frequent words one edit away that they are variants of."""
    return spelling.variants(table(spark, folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """How many tokens every document has."""
    rows = token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)
    return rows.withColumnRenamed("key", "doc_id")


def op13_infill(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a middle part moved to the end, and put back."""
    return infill.fill_in_middle(table(spark, folder, "documents"), texts=False).withColumnRenamed("key", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_sharding, op3_secrets, op4_bpe, op5_vectors, op6_quality, op7_packing, op8_repeats, op9_topk, op10_warc,
    op11_spelling, op12_token_counts, op13_infill)}

SQL = {
    "op9_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5""".strip(),
    "op10_warc": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""".strip(),
    "op13_infill": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents),
u AS (
  SELECT *, CAST(len(w) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(w) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(w) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50
              THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT *, array_to_string(w[1:least(x, y)], '') AS p, array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(w[greatest(x, y) + 1:], '') AS s
  FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c""".strip(),
}
