"""Watermark trace and late rows on a stream, batch by batch.

What is carried over is the largest event time of each source partition: one row per
partition. A batch's rows are ordered by the columns given, and come after those of the
batches before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.operators.ranges import ROWS_PER_RANGE
from millrace.operators.watermark import flag_late, trace
from millrace.session import materialise, working
from millrace.sinks.batches import WriteBatch

_STATE = "max_ts"


def trace_to_folder(
    root: str, ts: str, delay: str, source: list[str], order: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> WriteBatch:
    """A ``foreachBatch`` writer of each row with the running maximum and the watermark."""
    return _carrying(root, ts, source, lambda rows, initial: trace(
        rows, ts, delay, source, order, rows_per_range=rows_per_range, initial=initial
    ))


def late_to_folder(
    root: str, ts: str, width: str, delay: str, source: list[str], order: list[str],
    rows_per_range: int = ROWS_PER_RANGE,
) -> WriteBatch:
    """A ``foreachBatch`` writer of each row with its window and whether it came late."""

    def flag(rows: DataFrame, initial: DataFrame | None) -> DataFrame:
        seen = initial.withColumnRenamed(_STATE, "_seen") if initial is not None else None
        return flag_late(rows, ts, width, delay, source, order, rows_per_range=rows_per_range, initial=seen)

    return _carrying(root, ts, source, flag)


def _carrying(
    root: str, ts: str, source: list[str], work: Callable[[DataFrame, DataFrame | None], DataFrame]
) -> WriteBatch:
    """Rows go to ``rows/batch_id=N``, the maxima reached to ``state/batch_id=N``; a
    replayed batch replaces both."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with working(spark):
            rows = materialise(batch, "watermark-batch")
            initial = spark.read.parquet(f"{root}/state/batch_id={batch_id - 1}") if batch_id else None
            work(rows, initial).write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")
            reached = rows.groupBy(*source).agg(F.max(ts).alias(_STATE))
            if initial is not None:
                reached = reached.unionByName(initial).groupBy(*source).agg(F.max(_STATE).alias(_STATE))
            reached.write.mode("overwrite").parquet(f"{root}/state/batch_id={batch_id}")

    return write
