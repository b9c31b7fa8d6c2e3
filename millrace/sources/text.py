"""Lines of text as a stream, column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Newline-separated text from a TCP socket. Not replayable: for trials only."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def folder_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of the text files arriving in a folder; same columns, replayable."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)
