"""Printing, for trials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def print_rows(batch: DataFrame, batch_id: int) -> None:
    """Print every row of a batch, fetching one partition at a time."""
    print(f"batch {batch_id}: {', '.join(batch.columns)}")
    for row in batch.toLocalIterator():
        print(*row, sep=", ")


def printed(df: DataFrame, mode: str = "append") -> DataStreamWriter:
    """A writer that prints all rows of each batch, on the driver."""
    return df.writeStream.outputMode(mode).foreachBatch(print_rows)
