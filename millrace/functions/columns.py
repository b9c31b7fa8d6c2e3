"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
