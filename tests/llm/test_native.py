"""Sharding and mixing: DataFrame operations only."""

import math
from collections import Counter, defaultdict

import pytest

from millrace.llm import hilbert, mixing, prefixes

from .conftest import prose


def hot(make, n=400):
    return make([(i, prose(i % 37, 5 + i % 90), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(n)])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_curve_visits_every_cell_by_single_steps(spark):
    for n, bits in ((2, 3), (3, 3), (4, 2)):
        axes = [f"a{k}" for k in range(n)]
        side = 1 << bits
        cells = spark.range(side**n).selectExpr(*(f"id div {side**k} % {side} AS a{k}" for k in range(n)))
        rows = sorted(hilbert.with_curve(cells, axes, bits).collect(), key=lambda r: r.curve)
        assert [r.curve for r in rows] == list(range(side**n))
        assert all(sum(abs(a[x] - b[x]) for x in axes) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_shards_differ_by_one_row_and_slots_have_no_gap(make, odd, empty):
    for docs in (hot(make), odd):
        rows = hilbert.placed(docs).collect()
        assert len(rows) == docs.count()
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
        assert [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))] == sorted(r.curve for r in rows)
    assert hilbert.placed(empty).count() == 0


def test_neither_uses_python(make):
    assert not any(x in plan(f(hot(make, 40))) for f in (hilbert.placed, mixing.copies) for x in ("Python", "Arrow", "Pandas"))


def test_shards_prune_in_each_dimension(make):
    rows = [(i, "x" * (1 << (i * 7 % 12)), f"l{i * 5 % 8}", f"s{i * 3 % 16}") for i in range(2000)]
    where = {i: (la, s) for i, _, la, s in rows}
    by_shard = defaultdict(lambda: (set(), set()))
    for r in hilbert.placed(make(rows)).collect():
        by_shard[r.shard][0].add(where[r.doc_id][0])
        by_shard[r.shard][1].add(where[r.doc_id][1])
    assert sum(len(langs) for langs, _ in by_shard.values()) < 16 * 8 * 0.75
    assert sum(len(sources) for _, sources in by_shard.values()) < 16 * 16 * 0.75


def test_prefix_sums_do_not_depend_on_partitions(spark, make):
    docs = hot(make).selectExpr("doc_id", "source", "n_chars % 5 AS class", "n_chars AS v", "doc_id * 2654435761 % 4294967296 AS hash")
    expected, sums = {}, Counter()
    for r in sorted(docs.collect(), key=lambda r: (r.source, r["class"], r.hash, r.doc_id)):
        expected[r.doc_id] = sums[r.source]
        sums[r.source] += r.v
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for width in ("1", "4", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            got = prefixes.prefix_sums(docs, ["source"], ["class"], "v", ["doc_id"], "before").collect()
            assert {r.doc_id: r.before for r in got} == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def slow_targets(sizes, weights, most=3):
    """Share out, cap, and share what is left again, until none is above its cap."""
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free} if free else {}
        over = {s: most * sizes[s] for s in free if share[s] > most * sizes[s]}
        if not over:
            return capped | share
        capped |= over


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 10, "c": 10, "d": 300}, {"a": 5}, {"a": 0, "b": 7}, {"a": 0, "b": 0}, {"a": 1, "b": 1, "c": 1000, "d": 2, None: 3},
])
def test_targets_equal_repeated_sharing(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r for r in mixing.targets(mixing.cyclic_weights(rows)).collect()}
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: k % 3 + 1 for k, s in enumerate(order)}
    assert {s: r.weight for s, r in got.items()} == weights
    for source, target in slow_targets(sizes, weights).items():
        assert math.isclose(got[source].target, target, abs_tol=1e-6)


def test_mix_comes_near_its_targets_and_reruns_agree(make):
    docs = hot(make, 3000)
    rows = mixing.copies(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.copies(docs.repartition(5)).collect()))
    taken, largest = Counter(), Counter()
    for r in rows:
        assert 0 <= r.copies <= 3
        assert abs(r.copies - (r.target / r.source_size if r.source_size else 0)) < 1
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for r in rows:
        assert abs(taken[r.source] - r.target) <= max(0.02 * r.target, 2 * largest[r.source])
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in rows if r.copies})


def test_odd_rows_mix(odd, empty):
    rows = mixing.copies(odd).collect()
    assert len(rows) == odd.count() and all(r.copies == 0 for r in rows if r.size == 0)
    expected = Counter()
    for r in rows:
        expected[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixing.mixed(odd).collect()) == +expected
    assert mixing.copies(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_size_classes_follow_sizes(spark):
    rows = spark.range(1 << 15).select("id", mixing.size_class(mixing.F.col("id")).alias("c")).orderBy("id").collect()
    assert all(0 <= b.c - a.c <= 1 for a, b in zip(rows, rows[1:], strict=False))
    assert all(b.id < 1.25 * a.id for a, b in zip(rows[9:], rows[10:], strict=False) if a.c == b.c)
