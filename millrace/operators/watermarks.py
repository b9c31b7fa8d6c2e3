"""One watermark over several sources.

Each source raises its own maximum as its rows arrive; the watermark is the smallest of these
maxima less a delay, so a source that lags holds it back. It is null until every source has
been heard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from millrace.operators.ranges import RANGE, ROWS_PER_RANGE, add_range

_SEED = "_is_seed"
_MICROS = "_micros"
_REACHED = "_reached"
#: Cells of rows by sources that are worked on at a time.
_CELLS = 1 << 21
_NOTHING = np.iinfo(np.int64).min


def min_trace(
    df: DataFrame,
    ts: str,
    delay: str,
    source: str,
    order: list[str],
    name: str = "wm",
    include_current: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Each row with ``name``, the watermark over all sources of the table after it, or
    before it with ``include_current`` off.

    ``order`` is the order of arrival over all sources, without ties. Rows without a time
    raise nothing; rows without a source are one source. The rows are cut into ranges of
    that order: each source's maximum of the ranges before is carried into a range as a seed
    row, and the ranges run independently, a batch of rows at a time. What is carried is a
    row per source and range.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    ranged, ranges = add_range(df.withColumn(_MICROS, micros), [], order, rows_per_range)
    reached = ranged.groupBy(source, RANGE).agg(F.max(_MICROS).alias(_MICROS))
    # every source is in every range, also where it has no rows
    places = F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias(RANGE)
    everywhere = ranged.select(source).distinct().select(source, places)
    all_places = everywhere.withColumn(_MICROS, F.lit(None).cast("bigint")).unionByName(reached)
    one = all_places.groupBy(source, RANGE).agg(F.max(_MICROS).alias(_MICROS))
    earlier = Window.partitionBy(source).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    seeds = one.withColumn(_MICROS, F.max(_MICROS).over(earlier)).withColumn(_SEED, F.lit(True))
    rows = ranged.withColumn(_SEED, F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    rows = rows.repartition(RANGE).sortWithinPartitions(RANGE, F.col(_SEED).desc(), *order)
    schema = T.StructType([*rows.schema.fields, T.StructField(_REACHED, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, codes = None, {}
        state = np.zeros(0, np.int64)
        for batch in batches:
            places = batch[RANGE].to_numpy()
            for part in np.split(np.arange(len(places)), np.flatnonzero(np.diff(places)) + 1):
                if not len(part):
                    continue
                if places[part[0]] != number:
                    number, codes, state = places[part[0]], {}, np.zeros(0, np.int64)
                rows = batch.slice(int(part[0]), len(part))
                kinds = rows[source].to_pylist()
                times = rows[_MICROS].fill_null(_NOTHING).to_numpy()
                seeded = int(np.sum(rows[_SEED].to_numpy(zero_copy_only=False)))
                for kind in kinds[:seeded]:
                    codes[kind] = len(codes)
                state = np.concatenate([state, times[:seeded]])
                of = np.array([codes[kind] for kind in kinds[seeded:]], np.int64)
                low, state = smallest(of, times[seeded:], state, include_current)
                rows = rows.slice(seeded)
                values = pa.array(low, pa.int64(), mask=low == _NOTHING)
                yield pa.RecordBatch.from_arrays([*rows.columns, values], names=[*rows.schema.names, _REACHED])

    found = rows.mapInArrow(run, schema)
    clock = F.timestamp_micros(_REACHED).cast(df.schema[ts].dataType)
    return found.withColumn(name, clock - F.expr(f"INTERVAL {delay}")).drop(_MICROS, _SEED, RANGE, _REACHED)


def smallest(of: np.ndarray, times: np.ndarray, state: np.ndarray, include_current: bool) -> tuple[np.ndarray, np.ndarray]:
    """At each row the smallest of the sources' maxima, and the maxima after all rows.
    ``of``: each row's source, a place in ``state``."""
    out = [np.zeros(0, np.int64)]
    step = max(_CELLS // max(len(state), 1), 1)
    for at in range(0, len(of), step):
        some, when = of[at : at + step], times[at : at + step]
        seen = np.full((len(some) + 1, len(state)), _NOTHING)
        seen[0] = state
        seen[np.arange(1, len(some) + 1), some] = when
        np.maximum.accumulate(seen, axis=0, out=seen)
        low = seen.min(axis=1)
        out.append(low[1:] if include_current else low[:-1])
        state = seen[-1]
    return np.concatenate(out), state
