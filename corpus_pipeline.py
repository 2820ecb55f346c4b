"""A training corpus from raw documents: good texts, one of each near-duplicate group, without repeats or secrets, packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordinate.llm import credentials, packing, quality, repeats, simhash
from ordinate.llm.common import small_batches, stored, table
from ordinate.llm.queries import GOOD

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.  Empty texts, which it cannot judge, go."""
    small_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*COLUMNS), model, name="quality_score").where(F.col("quality_score") >= GOOD).select(*COLUMNS)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id: five-word shingles, similarity 0.8 or more.

    Of a group's rows with the smallest id, the text of the least hash stays, once.  Rows without an id come last.
    """
    small_batches(spark)
    groups = simhash.similar_groups(docs, shingle=5, least=0.8)
    least = F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("f_id"), F.col("mark").alias("f_mark")))
    first = groups.groupBy("root").agg(least.alias("first")).select("first.f_id", "first.f_mark")
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("mark") == F.col("f_mark"))
    kept = docs.select(*COLUMNS).withColumn("mark", mark).join(first.hint("merge"), same, "left_semi")
    return kept.dropDuplicates(["doc_id", "mark"]).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur more than once; texts of which nothing is left go."""
    small_batches(spark)
    left = repeats.without_repeats(docs, text=True, keep=["lang", "source"])
    return left.select(
        F.col("key").alias("doc_id"), F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars")
    ).where(F.length(F.trim("text")) > 0)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which each secret and each part of a credential is replaced by the name of its kind."""
    return credentials.redacted(docs, keep=["lang", "source"]).select(
        F.col("key").alias("doc_id"), "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    small_batches(spark)
    rows = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return rows.withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality", good), ("near_duplicates", distinct), ("repeats", without_repeats), ("secrets", without_secrets), ("packing", packed)]

#: The stages learn, hash bit by bit and merge tokens; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each one's result a table in the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
