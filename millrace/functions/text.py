"""Splitting and delimited records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.columns import as_col


def split_tokens(text: str | Column, separator: str = " ") -> Column:
    """Tokens between single separators, without trailing empty ones.

    ``""`` gives one empty token; text made of separators only gives none.
    """
    text = as_col(text)
    # without an argument only spaces are trimmed, which is the faster form
    trimmed = F.rtrim(text) if separator == " " else F.rtrim(text, F.lit(separator))
    only_separators = (F.length(text) > 0) & (trimmed == "")
    none = F.array().cast("array<string>")
    return F.when(only_separators, none).otherwise(F.split(trimmed, re.escape(separator)))


def tokens(df: DataFrame, text: str, *keep: str, separator: str = " ", as_name: str = "word") -> DataFrame:
    """One row per token of each line of ``text``, paired with the count 1."""
    lines = df.select(*keep, F.explode(F.split(text, "\n")).alias("_line"))
    return lines.select(
        *keep, F.explode(split_tokens("_line", separator)).alias(as_name)
    ).withColumn("n", F.lit(1).cast("bigint"))


def _field(parts: Column, index: int, lenient: bool) -> Column:
    return F.get(parts, index) if lenient else parts[index]


def csv_key_ts(value: str | Column, lenient: bool = False) -> list[Column]:
    """``key,epochMillis`` → columns ``k`` and ``ts``.

    A bad record fails the job under ANSI mode; ``lenient`` gives nulls instead.
    """
    parts = split_tokens(value, ",")
    millis = _field(parts, 1, lenient)
    millis = millis.try_cast("bigint") if lenient else millis.cast("bigint")
    return [_field(parts, 0, lenient).alias("k"), F.timestamp_millis(millis).alias("ts")]


def csv_pair(value: str | Column, lenient: bool = False) -> list[Column]:
    """``name,clientId`` → columns ``name`` and ``client_id``."""
    parts = split_tokens(value, ",")
    return [
        _field(parts, 0, lenient).alias("name"),
        _field(parts, 1, lenient).alias("client_id"),
    ]


def topic_list(setting: str) -> list[str]:
    """The topics of a comma-separated setting; one topic when there is no comma."""
    return [t.strip() for t in setting.split(",") if t.strip()]
