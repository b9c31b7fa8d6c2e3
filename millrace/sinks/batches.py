"""What all batch writers share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

WriteBatch = Callable[[DataFrame, int], None]


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query a batch belongs to.

    Batches are numbered from 0 by each checkpoint. The id stays the same over the
    restarts of a checkpoint and is new with a new one, so it tells a replay of a
    batch from another batch of the same number.
    """
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
