"""Running pipelines on streams.

Row-wise operators and fitted feature specifications take a streaming DataFrame as
it is.  Operators that need a total order do not; ``per_micro_batch`` applies them
to each micro-batch by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ordinate.order import as_list
from ordinate.scratch import scratch_path


def unique_stream(df: DataFrame, columns, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """First row per distinct ``columns`` on a stream.

    Exact as it is: every value is remembered, so state grows with their number.  With
    ``event_time`` and ``delay`` a value is forgotten once the watermark, ``delay`` behind the
    latest event time, has passed it: it comes out again if it comes back after that, and
    rows later than the watermark are dropped.
    """
    if (event_time is None) != (delay is None):
        raise ValueError("give both event_time and delay, or neither")
    if delay is None:
        return df.dropDuplicates(as_list(columns))
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(as_list(columns))


def snapshot_stream(df: DataFrame, path: str, compression: str = "snappy", available_now: bool = True) -> StreamingQuery:
    """Append a stream to Parquet files at ``path``, exactly once, resuming where it stopped."""
    writer = (
        df.writeStream.format("parquet").option("compression", compression)
        .option("path", f"{path.rstrip('/')}/data").option("checkpointLocation", f"{path.rstrip('/')}/progress")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_available(df: DataFrame, what: str = "stream", rest: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Run a stream over the data available now and return its output as a table.

    ``rest`` makes further rows from the checkpoint, for what is still held when the stream has ended.
    """
    path = scratch_path(df.sparkSession, what)
    query = snapshot_stream(df, path)
    query.awaitTermination()
    out = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    return out.unionByName(rest(f"{path}/progress")) if rest else out


def per_micro_batch(
    df: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Apply a batch operator to every micro-batch and write what it gives.

    Each batch goes to its own directory, so a batch that is run again after a failure
    replaces its earlier output.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/micro_batch={batch_id}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
