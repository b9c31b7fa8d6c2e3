"""Keyed totals over a whole table or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import as_col


def keyed_totals(
    df: DataFrame, keys: list[str], name: str = "cnt", value: str | Column | None = None
) -> DataFrame:
    """The sum of ``value`` per key (rows are counted without one).

    Spark sums within each task before it shuffles, so a hot key sends one row
    per task. On a stream use output mode ``update``.
    """
    total = F.count(F.lit(1)) if value is None else F.sum(as_col(value))
    return df.groupBy(*keys).agg(total.alias(name))


def windowed_totals(
    df: DataFrame, ts: str, width: str, keys: list[str], name: str = "cnt",
    value: str | Column | None = None,
) -> DataFrame:
    """As ``keyed_totals``, per tumbling window of ``width``."""
    total = F.count(F.lit(1)) if value is None else F.sum(as_col(value))
    grouped = df.groupBy(*keys, F.window(ts, width).alias("_w")).agg(total.alias(name))
    return grouped.select(*keys, F.col("_w.start").alias("ws"), F.col("_w.end").alias("we"), name)
