"""Source positions as tables: ``topic, partition_value, offset_value``.

All of these shrink to one row per source partition within each task before the
shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Kafka's mark for "from the first record kept".
EARLIEST = -2

_PARTITION = ["topic", "partition_value"]


def newest(rows: DataFrame, *batch: str, keys: Sequence[str] = _PARTITION) -> DataFrame:
    """The largest offset per source partition (and per ``batch`` columns). ``keys`` name
    the partition; the history of one topic has no topic column."""
    return rows.groupBy(*keys, *batch).agg(F.max("offset_value").alias("offset_value"))


def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored positions brought up to date with a batch, keeping the larger."""
    columns = [*_PARTITION, "offset_value"]
    return newest(stored.select(columns).unionByName(batch.select(columns)))


def compact(history: DataFrame, keys: Sequence[str] = _PARTITION) -> DataFrame:
    """An offset history as one row per source partition."""
    return newest(history, keys=keys)


def next_offsets(stored: DataFrame) -> DataFrame:
    """Where to go on reading: one past the largest stored offset."""
    return newest(stored).select(*_PARTITION, (F.col("offset_value") + 1).alias("start_offset"))


def starting_offsets(stored: DataFrame, partitions: dict[str, list[int]]) -> str:
    """The ``startingOffsets`` option for reading ``partitions`` (per topic).

    ``earliest`` when nothing is stored. Spark wants every partition named, so one
    without a stored offset starts at the earliest record. One number per source
    partition reaches the driver.
    """
    topics = F.col("topic").isin(list(partitions))
    found = {(r.topic, r.partition_value): r.start_offset for r in next_offsets(stored.where(topics)).collect()}
    if not found:
        return "earliest"
    return json.dumps(
        {t: {str(p): found.get((t, p), EARLIEST) for p in ps} for t, ps in partitions.items()}
    )
