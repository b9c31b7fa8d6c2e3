import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import tiling

from .conftest import prose

ITEMS = [(0, prose(1001, 30)), (1, prose(1002, 45)), (2, None), (3, ""), (4, "two words"), (5, prose(1002, 45))]


def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def slow_tiles(item, doc, least):
    """The longest common free run, marked again and again; how many words are marked."""
    free_i, free_d, covered = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and free_i[i + k] and free_d[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return covered
        covered += k
        free_i[i : i + k] = free_d[j : j + k] = [False] * k


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=25), st.lists(st.integers(1, 4), max_size=40))
def test_tiles_never_overlap_and_leave_no_run(item, doc):
    a, b = np.array(item, np.uint64), np.array(doc, np.uint64)
    found = tiling.tiles(a, b, list(range(max(len(doc) - 2, 0))), 3)
    used_a = [x for t in found for x in range(t.item_start, t.item_start + t.length)]
    used_b = [x for t in found for x in range(t.doc_start, t.doc_start + t.length)]
    assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
    assert all(item[t.item_start + k] == doc[t.doc_start + k] for t in found for k in range(t.length))
    free = lambda words, used: [None if i in used else w for i, w in enumerate(words)]
    grams = lambda words: {tuple(words[i : i + 3]) for i in range(len(words) - 2) if None not in words[i : i + 3]}
    assert not grams(free(item, set(used_a))) & grams(free(doc, set(used_b)))
    assert sum(t.length for t in found) == slow_tiles(item, doc, 3)
    longest = max((t.length for t in found), default=0)
    assert longest == (max_run(item, doc) if max_run(item, doc) >= 3 else 0)


def test_repeated_words_take_no_longer():
    began = time.perf_counter()
    for words in ([7], [7, 8], [7, 7, 8]):
        item, doc = (np.resize(np.array(words, np.uint64), n) for n in (200, 4000))
        assert sum(t.length for t in tiling.tiles(item, doc, list(range(3998)), 3)) == 200
    assert time.perf_counter() - began < 3


def max_run(a, b):
    return max((k for i in range(len(a)) for j in range(len(b)) for k in [run(a[i:], b[j:])]), default=0)


def run(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_planted_items_are_found_and_clean_documents_are_not(spark, make, odd):
    words = ITEMS[1][1].split()
    shuffled = " ".join(words[30:] + words[15:30] + words[:15]).upper()
    edited = " ".join("changed" if k % 9 == 4 else w for k, w in enumerate(words))
    docs = make([
        (1, prose(1) + "\n" + ITEMS[0][1] + ", " + prose(2), None, None), (2, prose(3) + " " + shuffled, None, None),
        (3, prose(4), None, None), (4, " ".join(words[:15]) + " " + prose(5), None, None), (5, edited, None, None),
        (6, "here are TWO, words!", None, None), (7, None, None, None),
    ])
    found = {(r.doc_id, r.item_id): r for r in tiling.leaks(docs, benchmark(spark)).collect()}
    assert set(found) == {(1, 0), (2, 1), (2, 5), (5, 1), (5, 5), (6, 4)}
    assert len(found[2, 1].tiles) == 3 and found[2, 1].coverage == 1 and 0.6 < found[5, 1].coverage < 1
    kept = tiling.decontaminated(docs, benchmark(spark))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 7]
    assert tiling.decontaminated(odd, benchmark(spark)).count() == odd.count()
    assert tiling.leaks(odd.where("false"), benchmark(spark)).count() == 0
    assert tiling.leaks(docs, benchmark(spark).where("false")).count() == 0
    assert tiling.decontaminated(docs, benchmark(spark).where("false")).count() == docs.count()


def test_a_benchmark_goes_through_in_blocks(spark, make):
    blocks = list(tiling.blocks_of(benchmark(spark), 3, block_bytes=100))
    assert [i for b in blocks for i in b.ids] == [i for i, _ in ITEMS] and len(blocks) > 2
