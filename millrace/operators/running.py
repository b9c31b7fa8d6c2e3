"""Running values per key in arrival order.

Rows are dealt out by ranges of keys and order: a key that lies in several is summed up by
range first, the value reached before a range starts is carried into it as one seed row,
and the ranges then run independently. No task holds a whole hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.ranges import RANGE, ROWS_PER_RANGE, add_range, at_edges

_VALUE = "_value"
_SEED = "_is_seed"

_COMBINE = {"sum": F.sum, "max": F.max}


def running(
    df: DataFrame,
    *,
    value: str | Column,
    how: str,
    order: list[str],
    name: str,
    keys: list[str] | None = None,
    include_current: bool = True,
    initial: DataFrame | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``name``: the running ``sum`` or ``max`` of ``value`` per ``keys``.

    ``order`` must order the rows of a key without ties; its columns may be of any type
    that can be ordered, nulls first. With ``include_current`` off, a row sees only the
    rows before it (null for the first). ``initial`` holds the values reached before this
    table, as ``keys`` and ``name``; of these, only the table's keys are looked at.
    """
    combine = _COMBINE[how]
    keys = keys or []
    upto = Window.currentRow if include_current else -1
    source = df.withColumn(_VALUE, F.col(value) if isinstance(value, str) else value)
    ranged, ranges = add_range(source, keys, order, rows_per_range)

    if ranges == 1 and initial is None:
        ordered = Window.partitionBy(*keys).orderBy(*order)
        seen = ordered.rowsBetween(Window.unboundedPreceding, upto)
        return ranged.withColumn(name, combine(_VALUE).over(seen)).drop(_VALUE, RANGE)

    carried = ranged if initial is not None else at_edges(ranged, keys)
    totals = carried.groupBy(*keys, RANGE).agg(combine(_VALUE).alias(_VALUE))
    if initial is not None:
        before_all = F.lit(-1).alias(RANGE)
        known = of_keys(initial.select(*keys, name), ranged, keys)
        totals = totals.unionByName(known.select(*keys, before_all, F.col(name).alias(_VALUE)))
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    seeds = (
        totals.withColumn(_VALUE, combine(_VALUE).over(earlier))
        .where(F.col(_VALUE).isNotNull() & (F.col(RANGE) >= 0))
        .withColumn(_SEED, F.lit(True))
    )
    rows = ranged.withColumn(_SEED, F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    within = (
        Window.partitionBy(*keys, RANGE)
        .orderBy(F.col(_SEED).desc(), *order)
        .rowsBetween(Window.unboundedPreceding, upto)
    )
    return (
        rows.withColumn(name, combine(_VALUE).over(within))
        .where(~F.col(_SEED))
        .drop(_VALUE, _SEED, RANGE)
    )


def of_keys(totals: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The totals of keys that ``rows`` has; null keys are keys too."""
    if not keys:
        return totals
    wanted = rows.select(*[F.col(k).alias(f"_of_{k}") for k in keys]).distinct()
    return totals.join(wanted, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], "left_semi")


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    value: str | Column | None = None,
    initial: DataFrame | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The changelog of a keyed sum: every input row with the total reached by it.
    Without ``value`` rows are counted."""
    value = F.lit(1).cast("bigint") if value is None else value
    return running(
        df, value=value, how="sum", keys=keys, order=order, name=name,
        initial=initial, rows_per_range=rows_per_range,
    )


def running_max(
    df: DataFrame,
    value: str,
    keys: list[str],
    order: list[str],
    name: str,
    include_current: bool = True,
    initial: DataFrame | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Each row with the largest ``value`` among the rows up to it."""
    return running(
        df, value=value, how="max", keys=keys, order=order, name=name,
        include_current=include_current, initial=initial, rows_per_range=rows_per_range,
    )
