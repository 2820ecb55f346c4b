"""A running reduction of a whole stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_BATCH = "micro_batch"


def reduce_stream(
    df: DataFrame, aggregates: dict[str, Column], path: str, key=None, available_now: bool = True
) -> StreamingQuery:
    """Reduce everything that a stream has given so far, with Column aggregates, after each micro-batch.

    Tasks make partial aggregates of a micro-batch's rows; only those reach the state, which is one row, or one
    for each ``key``, and survives restarts with the progress below ``path``.  A micro-batch writes the groups
    that it changed to a folder of its own, so one that is run again replaces what it wrote.
    :func:`reduced` reads the totals.

    The aggregates must be such as Spark keeps on streams: no distinct ones, and no order within a group.
    """
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    taken = {*keys, _BATCH} & set(aggregates) | {_BATCH} & set(keys)
    if taken:
        raise ValueError(f"{sorted(taken)} cannot name an aggregate here")
    base = path.rstrip("/")
    made = [c.alias(n) for n, c in aggregates.items()]
    totals = df.groupBy(*keys).agg(*made)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/totals/{_BATCH}={batch_id}")

    writer = totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/progress")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def reduced(spark: SparkSession, path: str, key=None) -> DataFrame:
    """The latest totals that :func:`reduce_stream` wrote: of each key, what its last micro-batch gave."""
    keys = [] if key is None else [key] if isinstance(key, str) else list(key)
    rows = spark.read.parquet(f"{path.rstrip('/')}/totals")
    values = [c for c in rows.columns if c not in (*keys, _BATCH)]
    last = F.max_by(F.struct(*[F.col(f"`{c}`") for c in values]), F.col(_BATCH)).alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, *[F.col(f"last.`{c}`").alias(c) for c in values])
