"""Bounded lateness in arrival order.

The watermark follows the largest event time seen so far, less a delay. It is kept
per source partition, as every partition has its own arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.ranges import ROWS_PER_RANGE
from millrace.operators.running import running_max
from millrace.operators.windows import window_of


def trace(
    df: DataFrame,
    ts: str,
    delay: str,
    source: list[str],
    order: list[str],
    rows_per_range: int = ROWS_PER_RANGE,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Each row with the running maximum of ``ts`` and the watermark after it.
    ``initial``: per source, the maximum before this table, as ``max_ts``."""
    seen = running_max(df, ts, source, order, "max_ts", initial=initial, rows_per_range=rows_per_range)
    return seen.withColumn("wm", F.col("max_ts") - F.expr(f"INTERVAL {delay}"))


def flag_late(
    df: DataFrame,
    ts: str,
    width: str,
    delay: str,
    source: list[str],
    order: list[str],
    rows_per_range: int = ROWS_PER_RANGE,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Each row with its window bounds and ``is_late``: whether the watermark had
    already closed that window when the row arrived.

    A window closes when the watermark reaches its last millisecond. A row without a
    time has no window and is never late. ``initial``: per source, the largest time
    before this table, as ``_seen``.
    """
    windowed = window_of(df, ts, width).withColumns({"ws": F.col("_w.start"), "we": F.col("_w.end")})
    seen = running_max(
        windowed.drop("_w"), ts, source, order, "_seen",
        include_current=False, initial=initial, rows_per_range=rows_per_range,
    )
    last = F.col("we") - F.expr("INTERVAL 1 MILLISECOND")
    late = last <= F.col("_seen") - F.expr(f"INTERVAL {delay}")
    return seen.withColumn("is_late", F.coalesce(late, F.lit(False))).drop("_seen")


def drop_late(df: DataFrame, *args, **kwargs) -> DataFrame:
    """The rows that arrived in time; arguments as in ``flag_late``."""
    return flag_late(df, *args, **kwargs).where(~F.col("is_late")).drop("is_late")
