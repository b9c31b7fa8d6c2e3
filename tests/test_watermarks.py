"""One watermark over several sources, against a plain walk over the rows."""

import datetime
import random

import pytest

from millrace.operators.watermarks import min_trace

START = datetime.datetime(2024, 1, 1)
SCHEMA = "place int, source string, ts timestamp_ntz"


def arrivals(n=300):
    rng = random.Random(5)
    rows = []
    for place in range(n):
        source = rng.choice(["a", "b", None]) if place < 200 else rng.choice(["a", "b", None, "late"])
        ts = START + datetime.timedelta(seconds=place + rng.randint(-40, 40))
        rows.append((place, source, None if place % 11 == 0 else ts))
    return rows


def walked(rows, include_current):
    reached, out = dict.fromkeys({source for _, source, _ in rows}), {}
    for place, source, ts in rows:
        before = dict(reached)
        if ts is not None:
            reached[source] = max(ts, reached[source] or ts)
        known = list((reached if include_current else before).values())
        out[place] = None if None in known else min(known) - datetime.timedelta(seconds=10)
    return out


@pytest.mark.parametrize("rows_per_range", [7, 100, 1000])
@pytest.mark.parametrize("include_current", [True, False])
def test_watermark_follows_the_slowest_source(spark, rows_per_range, include_current):
    rows = arrivals()
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).repartition(3)
    got = min_trace(df, "ts", "10 SECONDS", "source", ["place"], "wm", include_current, rows_per_range)
    assert got.columns == ["place", "source", "ts", "wm"]
    found = got.collect()
    assert len(found) == len(rows) and {(r.place, r.source, r.ts) for r in found} == set(rows)
    assert {r.place: r.wm for r in found} == walked(rows, include_current)


def test_tables_without_rows_or_times(spark):
    assert min_trace(spark.createDataFrame([], SCHEMA), "ts", "1 SECOND", "source", ["place"]).count() == 0
    df = spark.createDataFrame([(1, "a", None), (2, None, START)], SCHEMA)
    assert [r.wm for r in min_trace(df, "ts", "1 SECOND", "source", ["place"]).collect()] == [None, None]
