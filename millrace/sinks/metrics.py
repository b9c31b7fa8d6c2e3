"""Counts and times of batches, as measured by Spark, and of the tables that they are written to."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress


def observe_kinds(routed: DataFrame, name: str = "rows") -> DataFrame:
    """Counts the rows of each batch, in all and per kind, as they pass."""
    def of(kind: str):
        return F.count_if(F.col("kind") == kind).alias(kind)

    return routed.observe(name, F.count(F.lit(1)).alias("all"), of("group"), of("member"), of("corrupt"))


class BatchMetrics(StreamingQueryListener):
    """Measures of every batch of the queries run while it listens, from the first on."""

    def __init__(self, keep: Callable[[dict], None] | None = None) -> None:
        """``keep`` gets one entry per batch, to write it somewhere; without it they are
        gathered in ``entries``."""
        self.entries: list[dict] = []
        self._keep = keep or self.entries.append

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self._keep(metrics_of(event.progress))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def metrics_of(progress: StreamingQueryProgress) -> dict:
    """Query, batch id, rows read, milliseconds and observed counts of a batch."""
    return {
        "query": str(progress.id),
        "batch_id": progress.batchId,
        "rows": progress.numInputRows,
        "millis": progress.durationMs.get("triggerExecution"),
        **{k: v for row in progress.observedMetrics.values() for k, v in row.asDict().items()},
    }


def batch_metrics(query: StreamingQuery) -> list[dict]:
    """The entries of the batches that Spark still remembers; ``BatchMetrics`` has all."""
    return [metrics_of(p) for p in query.recentProgress]


#: Gets the entries of the tables that a batch was written to: run, batch_id, table, rows, millis.
KeepTables = Callable[[list[dict]], None]
_TABLES_SCHEMA = "run string, batch_id bigint, table string, rows bigint, millis bigint"


def timed_write(df: DataFrame, write: Callable[[DataFrame], None]) -> tuple[int, int]:
    """Rows that pass in the one job of ``write``, counted by it, and its milliseconds."""
    seen, begin = Observation(), time.monotonic()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"], millis_since(begin)


def millis_since(begin: float) -> int:
    return round((time.monotonic() - begin) * 1000)


def table_metrics_to_folder(spark: SparkSession, root: str) -> KeepTables:
    """Adds the entries of each batch to a table in ``root``: one row per table written."""

    def keep(entries: list[dict]) -> None:
        if entries:
            spark.createDataFrame(entries, _TABLES_SCHEMA).coalesce(1).write.mode("append").parquet(root)

    return keep
