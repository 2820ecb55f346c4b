"""Values given in the program, and number sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ordinate.functions.hashing import HASH_BITS, seeded_hash
from ordinate.operators.batching import unbatch


def tensors_dataset(spark: SparkSession, tensors: dict, schema=None) -> DataFrame:
    """One row that holds everything, one column per name."""
    return spark.createDataFrame([tuple(tensors.values())], schema or list(tensors))


def tensor_slices_dataset(spark: SparkSession, tensors: dict, schema=None, name: str = "pos") -> DataFrame:
    """One row per slice of equally long lists, numbered by ``name``."""
    sizes = {k: len(v) for k, v in tensors.items()}
    if len(set(sizes.values())) > 1:
        raise ValueError(f"all components must be equally long, found {sizes}")
    whole = tensors_dataset(spark, {k: list(v) for k, v in tensors.items()}, schema).withColumn("__one", F.lit(0))
    return unbatch(whole, "__one", list(tensors), name).drop("__one")


def sparse_slices(
    coo: DataFrame, rows: int | DataFrame, row: str = "row", col: str = "col", value: str = "value"
) -> DataFrame:
    """Rows of a sparse matrix given by its ``(row, col, value)`` entries.

    One output row per matrix row, empty ones included, with ``entries`` mapping
    column to value.  ``rows`` is the row count, or a DataFrame holding every row id
    in its column ``row``.
    """
    spark = coo.sparkSession
    every = spark.range(rows).toDF(row) if isinstance(rows, int) else rows.select(row).distinct()
    items = coo.groupBy(row).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(col).alias("key"), F.col(value).alias("value"))))).alias("entries")
    )
    kinds = coo.schema
    empty = F.create_map().cast(f"map<{kinds[col].dataType.simpleString()},{kinds[value].dataType.simpleString()}>")
    return every.join(items, row, "left").withColumn("entries", F.coalesce("entries", empty))


def range_dataset(spark: SparkSession, start: int = 0, stop: int = 0, by: int = 1, dtype: str = "bigint", name: str = "value") -> DataFrame:
    """``start``, ``start + by``, ... up to but not including ``stop``."""
    return spark.range(start, stop, by).select(F.col("id").cast(dtype).alias(name))


def random_integer_dataset(spark: SparkSession, count: int, seed: int, name: str = "value") -> DataFrame:
    """``count`` random bigints, the same for the same seed; ordered by ``pos``.

    Endless in principle, so the number wanted has to be given.
    """
    if count is None:
        raise ValueError("an endless sequence cannot be a table; give a count")
    draws = spark.range(count).withColumnRenamed("id", "pos")
    low = seeded_hash(seed, F.col("pos"), F.lit("low"))
    high = F.pmod(seeded_hash(seed, F.col("pos"), F.lit("high")), F.lit(16))
    return draws.withColumn(name, F.shiftleft(high, HASH_BITS).bitwiseOR(low))
