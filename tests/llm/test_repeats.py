from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import repeats

from .conftest import prose


def slow(texts, length):
    """Windows counted as word sequences."""
    split = [(t or "").encode().split() for t in texts]
    times = Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - length + 1) if times[tuple(w[i : i + length])] > 1 for j in range(i, i + length)}
        out.append((len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def check(make, texts, length=repeats.LENGTH, ids=None, **sizes):
    ids = ids or list(range(len(texts)))
    docs = make([(i, t, "en", "a") for i, t in zip(ids, texts, strict=True)]).repartition(3)
    got = repeats.without_repeats(docs, length, **sizes).collect()
    want = [(i, *row) for i, row in zip(ids, slow(texts, length), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


PASSAGE = prose(77, 50)
TEXTS = [
    *(prose(i, 90) for i in range(12)), prose(3, 90), prose(4, 80) + " other end",
    *(f"{prose(100 + i, 20)} {PASSAGE} {prose(200 + i, 20)}" for i in range(30)),
    *(f"{prose(300, 40)} {i} {prose(301, 40)}" for i in range(30)),  # near copies
    "zero " * 500, "one two " * 60, prose(500, 35), prose(500, 35), prose(501, 34), prose(501, 34), None, "", " \n\t ",
    "Case " * 34 + "end", "case " * 34 + "end", "日本語 ☃ " * 30, prose(600, 40).replace(" ", "\x0b \r"), prose(600, 40),
    "a b " * 40, "x" * 200_000, prose(1, 20_000),
]


@pytest.mark.parametrize("sizes", [{}, {"seed_windows": 5}, {"shard_words": 200, "seed_windows": 40}])
def test_whole_texts_lose_the_runs_that_occur_again(make, sizes):
    check(make, TEXTS, **sizes)


def test_repeated_rows_and_rows_without_an_id_count_each(make):
    texts = [prose(1, 60), prose(1, 60), prose(2, 60), prose(2, 60), prose(3, 60), prose(4, 60)]
    check(make, texts, ids=[1, 1, None, None, 2, 2])
    check(make, texts, ids=[1, 1, None, None, 2, 2], seed_windows=1)


def test_other_lengths(make):
    for length in (1, 5, 12, 13):
        check(make, TEXTS[:40] + TEXTS[-12:-3], length)


def test_odd_and_empty_tables(odd, empty):
    assert repeats.without_repeats(odd).count() == odd.count()
    assert repeats.without_repeats(empty).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=14), st.integers(1, 3)), max_size=5), st.lists(st.integers(0, 3), max_size=14), st.integers(1, 4))
def test_the_automaton_knows_every_run_and_its_number(weighted, read, least):
    runs = Counter()
    for sequence, weight in weighted:
        for i in range(len(sequence)):
            for j in range(i + 1, len(sequence) + 1):
                runs[tuple(sequence[i:j])] += weight
    automaton = repeats.Automaton([s for s, _ in weighted], [w for _, w in weighted])
    for at, (length, state) in enumerate(automaton.statistics(read)):
        longest = next(n for n in range(at + 1, -1, -1) if not n or tuple(read[at + 1 - n : at + 1]) in runs)
        assert length == longest
        if length:
            assert automaton.length[automaton.link[state]] < length <= automaton.length[state]
            assert automaton.times[state] == runs[tuple(read[at + 1 - length : at + 1])]
    covered = {k for a, b in automaton.repeated(read, least) for k in range(a, b)}
    assert covered == {
        k for i in range(len(read) - least + 1) if runs[tuple(read[i : i + least])] > 1 for k in range(i, i + least)
    }
