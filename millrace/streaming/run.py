"""Starting streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks.batches import WriteBatch


def start_batches(
    df: DataFrame, write: WriteBatch, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Run ``write`` on the rows of each interval ``every`` (such as ``30 seconds``),
    or on what there is now and then stop when no interval is given.

    The position is kept in ``checkpoint`` with each batch and outlives the query, so
    a restart goes on from there.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def start_files(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append the rows of a stream to parquet files in ``path``, exactly once."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
