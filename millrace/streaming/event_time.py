"""Event time on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_bounded_lateness(df: DataFrame, ts: str, seconds: int, exact: bool = True) -> DataFrame:
    """``df`` with a watermark ``seconds`` behind the newest event time.

    Spark closes a window when the watermark reaches its end. With ``exact`` it
    closes one millisecond earlier, when the watermark reaches the window's last
    millisecond. A delay cannot be below 0: there it closes at its end.
    """
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    delay = f"{max(seconds * 1000 - 1, 0)} milliseconds" if exact else f"{seconds} seconds"
    return df.withWatermark(ts, delay)
