"""Cut ordered rows into ranges of bounded size.

A running value needs the rows of a key in order, but one key may hold a third of all
rows, so a key must not become one task. Rows are dealt out by ranges over the keys and
all ordering columns, of any type that Spark can order; rows of a lower range come before
all rows of a higher one.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import DataFrame, functions as F

from millrace.session import materialise

RANGE = "_range"
ROWS_PER_RANGE = 4_000_000
# Fewer rows are not worth a task of their own.
_ROWS_PER_TASK = 1_000
_PLACE = "_place_in_part"
_PART_BITS = 33


def add_range(
    df: DataFrame, keys: list[str], order: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> tuple[DataFrame, int]:
    """``df`` with the column ``_range``, and how many ranges there are.

    ``df`` is computed once and written to the shared folder; the number of rows is read
    from what was written. Where more than one range is needed, Spark sorts the rows over as
    many tasks as the session's shuffles have, whatever the number of ranges: these are cut from
    the sorted rows, which are written once more, so that everything computed from them later
    sees the same cuts. Every range but the last has ``rows_per_range`` rows.
    """
    if df.isStreaming:
        raise ValueError("running values on a stream go batch by batch: see millrace.streaming")
    written = materialise(df, "running-rows")
    rows = written.count()
    ranges = math.ceil(rows / rows_per_range)
    if ranges <= 1:
        return written.withColumn(RANGE, F.lit(0)), 1
    shuffles = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(shuffles, math.ceil(rows / _ROWS_PER_TASK)), math.ceil(rows / ROWS_PER_RANGE))
    sorted_rows = written.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    placed = materialise(sorted_rows.withColumn(_PLACE, F.monotonically_increasing_id()), "running-ranges")
    part = F.shiftright(_PLACE, _PART_BITS).cast("int")
    sizes = dict(placed.groupBy(part).count().collect())  # a row per task
    before = accumulate((sizes.get(i, 0) for i in range(max(sizes))), initial=0)
    first = F.get(F.expr(f"array({', '.join(f'{n}L' for n in before)})"), part)
    place = first + F.col(_PLACE).bitwiseAND((1 << _PART_BITS) - 1)
    number = F.floor(place / F.lit(rows_per_range)).cast("int")
    return placed.withColumn(RANGE, number).drop(_PLACE), ranges


def at_edges(ranged: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of keys that begin or end a range: all that may lie in several."""
    if not keys:
        return ranged
    key = F.struct(*keys)
    edges = ranged.groupBy(RANGE).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    several = edges.select(F.explode(F.array("low", "high")).alias("_key")).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_key.{k}")) for k in keys]
    return ranged.join(several, same, "left_semi")
