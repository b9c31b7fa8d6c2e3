"""Tumbling windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import as_col
from millrace.functions.times import format_time
from millrace.operators.ranges import ROWS_PER_RANGE
from millrace.operators.running import running_totals

CHUNK_ROWS = 10_000


def tumbling(df: DataFrame, ts: str, width: str, keys: list[str]) -> DataFrame:
    """Per key and window: row count, earliest and latest time, window bounds. Rows
    without a time are in no window."""
    grouped = df.groupBy(*keys, F.window(ts, width).alias("_w")).agg(
        F.count(F.lit(1)).alias("cnt"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")
    )
    return grouped.select(
        *keys, "cnt", "min_ts", "max_ts",
        F.col("_w.start").alias("ws"), F.col("_w.end").alias("we"),
    )


def window_of(df: DataFrame, ts: str, width: str, name: str = "_w") -> DataFrame:
    """Each row with its window as a struct, null for a row without a time."""
    # Spark's window function leaves out rows whose time is null, so it never sees one
    some = F.coalesce(ts, F.lit("1970-01-01 00:00:00").cast(df.schema[ts].dataType))
    windowed = df.withColumn("_some_time", some).withColumn(name, F.window("_some_time", width))
    return windowed.withColumn(name, F.when(F.col(ts).isNotNull(), F.col(name))).drop("_some_time")


def assign_window(df: DataFrame, ts: str, width: str, name: str = "ws") -> DataFrame:
    """Each row with the start of its window; rows stay where they are, and a row without
    a time has none."""
    return window_of(df, ts, width).withColumn(name, F.col("_w.start")).drop("_w")


def window_counts(df: DataFrame, ts: str, width: str) -> DataFrame:
    """Rows per window over the whole table; rows without a time are in no window."""
    grouped = df.groupBy(F.window(ts, width).alias("_w")).agg(F.count(F.lit(1)).alias("cnt"))
    return grouped.select(F.col("_w.start").alias("ws"), "cnt")


def collect_window(
    df: DataFrame,
    ts: str,
    width: str,
    value: str | Column,
    order: list[str],
    keys: list[str] | None = None,
    name: str = "items",
    chunk_rows: int = CHUNK_ROWS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """All rows of a window as ordered lists.

    A window of any size is given in full as lists of at most ``chunk_rows``
    values, numbered by ``chunk``; one that fits is a single list. No list, and so
    no task, grows with the window. Rows without a time are listed under a null start.
    """
    keys = keys or []
    rows = assign_window(df, ts, width).select(
        *keys, "ws", *[c for c in order if c not in keys], as_col(value).alias("_item")
    )
    return in_lists(rows, [*keys, "ws"], order, name, chunk_rows, rows_per_range)


def in_lists(
    rows: DataFrame, keys: list[str], order: list[str], name: str, chunk_rows: int = CHUNK_ROWS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The values ``_item`` of each of the ``keys``, in order, in numbered lists."""
    numbered = running_totals(rows, keys=keys, order=order, name="_n", rows_per_range=rows_per_range)
    chunked = numbered.withColumn("chunk", F.expr(f"(_n - 1) div {chunk_rows}"))
    lists = chunked.groupBy(*keys, "chunk").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sort_array(F.collect_list(F.struct("_n", "_item"))).alias("_list"),
    )
    return lists.select(*keys, "chunk", "cnt", F.col("_list._item").alias(name))


# A window's rows in order, as batches, and what it is the window of.
WindowFunction = Callable[[dict, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def over_windows(
    df: DataFrame, ts: str, width: str, order: list[str], function: WindowFunction, schema: str, keys: list[str] | None = None
) -> DataFrame:
    """What a function of yours gives for the rows of each key's window.

    The function gets the window (``keys`` and its start ``ws``) and the window's rows, with
    all columns of ``df``, sorted by ``order`` and in Arrow batches of the session's size: a
    window is never held whole, however many rows it has. It yields batches of ``schema``,
    to which the window's columns are not added. Rows without a time are in no window. One
    task reads a window, as the function sees its rows one after another; a window read only
    in part is skipped to its end.
    """
    by = [*(keys or []), "ws"]
    rows = assign_window(df.where(F.col(ts).isNotNull()), ts, width)
    dealt = rows.repartition(*by).sortWithinPartitions(*by, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = windows_in(batches, by)
        part = next(parts, None)
        while part is not None:
            window, ended = part[0], []

            def rows_of_window(first=part, ended=ended) -> Iterator[pa.RecordBatch]:
                part = first
                while part is not None and part[0] == first[0]:
                    yield part[1].drop_columns(["ws"])
                    part = next(parts, None)
                ended.append(part)

            mine = rows_of_window()
            yield from function(window, mine)
            for _ in mine:
                pass
            part = ended[0]

    return dealt.mapInArrow(run, schema)


def windows_in(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """Batches cut where one of the columns changes, each with the values of these columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for name in by:
            codes = batch[name].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield {name: batch[name][a].as_py() for name in by}, batch.slice(a, b - a)


def report_line(windows: DataFrame, key: str) -> DataFrame:
    """One line per window: key and count after commas, then the four times with
    nothing between them. A null key reads ``null``."""
    times = F.concat(*[format_time(c) for c in ("min_ts", "max_ts", "ws", "we")])
    head = [F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col("cnt").cast("string")]
    return windows.select(F.concat_ws(",", *head, times).alias("line"))
