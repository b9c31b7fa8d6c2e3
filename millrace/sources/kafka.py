"""Kafka topics, and tables in the shape of Kafka messages.

Reading needs the public Kafka package for Spark on the class path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.columns import as_col
from millrace.functions.text import topic_list

KAFKA_SCHEMA = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topics: str,
    starting_offsets: str = "latest",
    records_per_batch: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """The messages of one topic or of a comma-separated list of topics.

    ``starting_offsets`` is ``earliest``, ``latest`` or the JSON of
    ``offsets.starting_offsets``; it counts for the first run only, after which the
    query's checkpoint holds the position. ``records_per_batch`` bounds a batch and
    ``min_partitions`` splits busy topic partitions over more tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topic_list(topics)))
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    if records_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", records_per_batch)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def message_text(messages: DataFrame) -> DataFrame:
    """The message values as UTF-8 text."""
    return messages.select(F.col("value").cast("string").alias("value"))


def as_messages(
    df: DataFrame, topic: str, number: str, payload: Column, partitions: int = 3
) -> DataFrame:
    """The rows of a table or stream in the shape of a topic's messages.

    ``number`` identifies a row: messages are dealt to partitions by it and keep its
    order, so offsets grow within a partition and need no sort. As in a compacted
    topic they may have gaps.
    """
    n = as_col(number)
    offset = F.expr(f"{number} div {partitions}")
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(payload).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (n % partitions).cast("int").alias("partition"),
        offset.alias("offset"),
        F.timestamp_seconds(F.lit(1_704_067_200) + offset).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
