"""Message decoding, routing by key presence, splitting and merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.messages import JSON_OPTIONS, as_long, decode_once, raw_text

GROUP, MEMBER, CORRUPT = "group", "member", "corrupt"

# Columns of a routed message; payload columns of the other kinds are null. ``value`` is
# the message itself, of corrupt ones only.
ROUTED_SCHEMA = (
    "kind string, id bigint, group_code string, group_id string, "
    "topic string, partition_value int, offset_value bigint, value binary"
)


# Values stay as they came. A null one is a value here, only a missing key is null.
_MESSAGE = "id variant, group_code variant, group_id variant, _corrupt_record string"


def kind_of(message: Column) -> Column:
    """``group`` when the key ``group_code`` is present (even as null), else
    ``member``; ``corrupt`` for text that is not a JSON object."""
    corrupt = message.isNull() | message["_corrupt_record"].isNotNull()
    return (
        F.when(corrupt, CORRUPT).when(message["group_code"].isNotNull(), GROUP).otherwise(MEMBER)
    )


def route(messages: DataFrame, raw: bool = False) -> DataFrame:
    """Kafka-shaped messages as routed rows carrying their source position.

    Text payloads are plain by default; ``raw`` keeps them as JSON text, quotes
    included. Each message is decoded once, and only the fields in use. One that cannot
    be decoded is kept as it came.
    """
    message = F.from_json(F.col("value").cast("string"), _MESSAGE, JSON_OPTIONS)
    decoded = decode_once(messages, message, "m", "topic", "partition", "offset", "value")
    m = F.col("m")
    text = raw_text if raw else (lambda v: v.cast("string"))
    kind = kind_of(m)
    return decoded.select(
        kind.alias("kind"),
        as_long(m["id"]).alias("id"),
        F.when(kind == GROUP, text(m["group_code"])).alias("group_code"),
        F.when(kind == MEMBER, text(m["group_id"])).alias("group_id"),
        "topic",
        F.col("partition").cast("int").alias("partition_value"),
        F.col("offset").alias("offset_value"),
        F.when(kind == CORRUPT, F.col("value").cast("binary")).alias("value"),
    )


def groups(routed: DataFrame) -> DataFrame:
    """The group rows, in the layout of the groups table."""
    return routed.where(F.col("kind") == GROUP).select("id", "group_code")


def members(routed: DataFrame) -> DataFrame:
    """The member rows, in the layout of the members table."""
    return routed.where(F.col("kind") == MEMBER).select("id", "group_id")


def corrupt(routed: DataFrame) -> DataFrame:
    """The messages that could not be decoded, with their source positions."""
    return routed.where(F.col("kind") == CORRUPT).select("topic", "partition_value", "offset_value", "value")


def union_streams(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)
