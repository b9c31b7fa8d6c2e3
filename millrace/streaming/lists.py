"""Lists of all rows of a window on a stream, given when the window closes.

Rows of open windows wait in the state store: a window's rows are dealt out to several
state keys, so that no task holds a large window alone, and each key has a timer at the
window's end. When time passes it, by the watermark or by the clock, all keys of the window
give out their rows in the same batch, and the batch's writer puts them in order and into
numbered lists, as ``operators.windows.collect_window`` does for tables.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from millrace.functions.columns import as_col
from millrace.operators.ranges import ROWS_PER_RANGE
from millrace.operators.windows import CHUNK_ROWS, in_lists
from millrace.session import materialise, working
from millrace.sinks.batches import WriteBatch

#: State keys that the rows of a window are dealt out to.
SALTS = 32


class Waiting(StatefulProcessor):
    """Keeps the rows of a key (window's end in milliseconds, salt) until its window ends.
    A row whose window has ended already is late and left out."""

    def __init__(self, schema: T.StructType, by_watermark: bool) -> None:
        self.schema, self.by_watermark = schema, by_watermark

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self.armed = handle.getValueState("armed", "armed boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:  # noqa: N802, N803
        end = key[0]
        if self.by_watermark and timerValues.getCurrentWatermarkInMs() >= end:
            return iter(())
        if not self.armed.exists():
            # a timer fires when time is past it: the window's last millisecond
            self.handle.registerTimer(end - 1)
            self.armed.update((True,))
        names = self.schema.names
        some: list[tuple] = []
        for row in rows:
            some.append(tuple(row[name] for name in names))
            if len(some) == 1000:
                self.rows.appendList(some)
                some = []
        if some:
            self.rows.appendList(some)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        row = Row("_end", "_salt", *self.schema.names)
        for values in self.rows.get():
            yield row(*key, *values)
        self.rows.clear()
        self.armed.clear()

    def close(self) -> None:
        pass


def closed_rows(
    df: DataFrame, ts: str | None, width: str, value: str | Column, order: list[str], keys: list[str] | None = None, salts: int = SALTS
) -> DataFrame:
    """The rows of a stream, as ``keys``, ``order``, ``_item`` and the window's start ``ws``,
    in the batch in which their window closes.

    ``ts`` is an event time with a watermark (see ``with_bounded_lateness``); with None a row
    belongs to the window of the clock in which it arrives. A row without a time is in no
    window. ``order`` must order the rows of a window without ties.
    """
    keys = keys or []
    by_watermark = ts is not None
    source = df if by_watermark else df.withColumn("_clock", F.current_timestamp())
    time = ts or "_clock"
    stamps = {c: dict(df.dtypes)[c] for c in order if dict(df.dtypes)[c] in ("timestamp", "timestamp_ntz")}
    # Spark leaves out what is older than the watermark: by this column, whole windows
    windowed = source.where(F.col(time).isNotNull()).withColumn("_w", F.window(time, width))
    columns = list(dict.fromkeys([*keys, *order]))
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in stamps}
    held = windowed.select(
        F.unix_millis(F.col("_w.end").cast("timestamp")).alias("_end"),
        F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int").alias("_salt"),
        F.unix_micros(F.col("_w.start").cast("timestamp")).alias("_start"),
        *[micros.get(c, F.col(c)) for c in columns], as_col(value).alias("_item"), "_w",
    )
    schema = T.StructType([f for f in held.schema if f.name not in ("_end", "_salt", "_w")])
    out = T.StructType([*[f for f in held.schema if f.name in ("_end", "_salt")], *schema])
    closed = held.groupBy("_end", "_salt").transformWithState(
        Waiting(schema, by_watermark), out, "Append", "EventTime" if by_watermark else "ProcessingTime"
    )
    kind = stamps.get(ts, "timestamp") if by_watermark else "timestamp"
    return closed.select(
        *[F.timestamp_micros(c).cast(stamps[c]).alias(c) if c in stamps else F.col(c) for c in columns],
        F.timestamp_micros("_start").cast(kind).alias("ws"), "_item",
    )


def lists_to_folder(
    root: str, order: list[str], keys: list[str] | None = None, name: str = "items", chunk_rows: int = CHUNK_ROWS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> WriteBatch:
    """A ``foreachBatch`` writer of ``closed_rows``: the lists of the windows that a batch
    closes go to ``batch_id=N``, numbered by ``chunk`` within each window. A replayed batch
    replaces them; a batch that closes no window leaves nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        with working(batch.sparkSession):
            rows = materialise(batch, "closed-rows")
            if not rows.isEmpty():
                lists = in_lists(rows, [*(keys or []), "ws"], order, name, chunk_rows, rows_per_range)
                lists.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return write
