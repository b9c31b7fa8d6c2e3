from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import minhash
from millrace.llm.components import components

from .conftest import prose
from .test_words import ASCII, WORD


def shingles(text, n):
    words = WORD.findall((text or "").translate(ASCII))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def slow(texts, like):
    """Every pair compared; the smallest id reachable."""
    sets = {i: shingles(t, like.shingle) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and like.linked(len(sets[a] & sets[b]), len(sets[a]), len(sets[b])):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(text, places, mark):
    words = text.split()
    for p in places:
        words[p % len(words)] = f"{mark}{p}"
    return " ".join(words)


def family(base, size, edits):
    """Copies of a text, each with its own words changed: many near the threshold."""
    return [edited(prose(base, 150), [(k * 31 + e * 53) % 150 for e in range(k % edits)], f"n{k}x") for k in range(size)]


@pytest.mark.parametrize("like", [minhash.Likeness(), minhash.Likeness(3, 85)])
def test_components_equal_all_pairs(make, like):
    chain = [edited(prose(77, 200), range(0, 2 * k, 2), "c") for k in range(12)]
    texts = dict(enumerate(
        [prose(i) for i in range(20)] + family(500, 60, 9) + family(501, 40, 14) + chain
        + [prose(3)] * 15 + [prose(4).upper(), None, "", "one", "ONE", "one two", "two one", "a b c", "a b c d e"]
    ))
    rows = minhash.near_duplicates(make([(i, t, None, None) for i, t in texts.items()]), like).collect()
    expected = slow(texts, like)
    assert len(rows) == len(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_odd_rows(odd, empty):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and all(r.kept for r in rows if r.doc_id is None or r.n_shingles == 0)
    assert {r.component_id for r in rows if r.doc_id in (3, 44)} == {3}
    kept = minhash.deduplicated(odd)
    assert kept.columns == odd.columns
    have = Counter(r.doc_id for r in kept.collect())
    assert have[3] == 1 and have[44] == 0 and have[None] == 2 and have[40] == 1 and have[43] == 1
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicated(empty).count() == 0


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_no_row_is_lost_for_another_of_its_id(spark, make, tasks):
    base = [(i, prose(i), "en", "a") for i in range(12)]
    rows = base + [(3, prose(100), "en", "a"), (4, prose(5) + " more", "en", "a"), (7, None, "en", "a"), (7, prose(7), "en", "a")]
    rows += [(None, prose(k % 3), "en", "a") for k in range(7)]
    docs = make(rows).selectExpr("*", "'p' AS _place", "'i' AS _id", "'n' AS _n", "'m' AS number", "'r' AS row").repartition(tasks)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert {(r._place, r._id, r._n, r.number, r.row) for r in found} == {("p", "i", "n", "m", "r")}
    want = Counter((i, t) for i, t, *_ in base if i != 5) + Counter([(3, prose(100)), (7, None)]) + Counter((None, prose(k % 3)) for k in range(7))
    # the near copy has the smaller id of its group
    assert Counter((r.doc_id, r.text) for r in found) == want + Counter([(4, prose(5) + " more")])


def test_groups_cut_into_blocks_lose_no_link(make, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    like = minhash.Likeness(3, 85)
    texts = dict(enumerate(family(502, 70, 12)))
    rows = minhash.near_duplicates(make([(i, t, None, None) for i, t in texts.items()]), like).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == slow(texts, like)


def test_estimates_are_near_the_true_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for common in (1800, 1400, 900, 100):
        a, b = np.unique(pool[:2000]), np.unique(pool[2000 - common : 4000 - common])
        both = minhash.packed(np.stack([minhash.minima(x, slice(minhash.MINIMA, None)) for x in (a, b)]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        found = minhash.estimated(minhash.equal_parts(both[:1], both[1:]), minhash.DEEP)[0]
        assert abs(found - true) < 0.06


def test_a_pair_at_the_threshold_is_hardly_ever_missed():
    for percent in (60, 80, 85, 95):
        like = minhash.Likeness(5, percent)
        assert (1 - like.threshold**like.rows) ** (minhash.MINIMA // like.rows) <= minhash.MISSED


def test_column_and_array_forms_count_alike(spark):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, (20, 12)) for _ in range(2))
    b[:, ::2] = a[:, ::2]
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)], "a array<long>, b array<long>")
    got = [r[0] for r in df.select(minhash.equal_parts_of("a", "b")).collect()]
    assert got == minhash.equal_parts(a.view(np.uint64), b.view(np.uint64)).tolist()


def test_long_chains_become_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r.id: r.component for r in components(links).collect()}
    assert found == {k: 0 for k in range(1, 61)} | {101: 100}
    assert components(links.where("false")).count() == 0


def test_texts_copied_for_the_deduplication_are_compressed_well(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * 9) for i in range(6)], "doc_id long, text string")
    got = minhash.deduplicated(docs)
    codecs = {pq.ParquetFile(path.removeprefix("file://").removeprefix("file:")).metadata.row_group(0).column(0).compression for path in got.inputFiles()}
    assert codecs == {"ZSTD"} and got.count() == 6
