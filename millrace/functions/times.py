"""Event times as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.columns import as_col


def wall_clock(millis: str | Column, zone: str = "UTC") -> Column:
    """Epoch milliseconds as the wall-clock time of ``zone``, whatever zone the
    session has."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(as_col(millis) / 1000).cast("decimal(18,6)")
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def format_time(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; a ``timestamp`` is shown in the session's zone, a
    ``timestamp_ntz`` as it is."""
    return F.substring(as_col(ts).cast("string"), 1, 19)


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz`` read as UTC."""
    ts = as_col(ts)
    minutes = (F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def utc_clock(ts: str | Column) -> Column:
    """A ``timestamp`` as its UTC wall-clock time, whatever zone the session has."""
    return F.convert_timezone(None, F.lit("UTC"), as_col(ts))
