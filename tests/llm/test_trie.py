import math
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from millrace.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, name string, path string, n string"


def slow(rows):
    """Every prefix in a dictionary."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))  # as SQL has it below 0
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = lambda x: sum(len(y) == len(x) + 1 and y[:-1] == x for y in members)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode().split()) for x in below if x)
        ends = sorted(c for c in inside if built[c] == node)
        out.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), children(node),
            sum(not children(x) for x in below), saved, sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def table(spark, rows):
    # with columns of the operator's own names
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def conversations():
    rows = []
    for c in range(70):
        for t in range(c % 6 + 1):
            rows.append((c, t, ("user", "assistant")[t % 2], f"turn {t} of {c % 3 if t < 3 else c} " * (t + 1)))
    rows += [(100, t, "user", "again") for t in range(14)]  # long
    rows += [(c, t, "user", "again") for c in (102, 103, 104) for t in range(12)]  # equal ones
    rows += [(121, 0, None, None), (121, None, "user", "first"), (122, 5, "", ""), (123, 1, "user", None)]
    rows += [(None, 0, "user", "lost"), (145, 0, "user", "no base"), (165, 0, "user", "x"), (165, 1, "user", "x y")]
    rows += [(-5, 0, "user", "negative"), (-20, 0, "user", "base"), (9_000_000_000, 0, "user", "big")]
    return rows


@pytest.mark.parametrize("group_turns", [trie.GROUP_TURNS, 30, 0])
def test_nodes_are_those_of_all_prefixes(spark, group_turns, monkeypatch):
    rows = conversations()
    plain = trie.nodes_of
    monkeypatch.setattr(trie, "nodes_of", lambda paths, _: plain(paths, group_turns))
    got = [tuple(r) for r in trie.shared_starts(table(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, slow(rows)))


def test_long_lists_of_ends_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    rows = [(20 * c, 0, "user", "hello") for c in range(300)]
    got = [tuple(r) for r in trie.shared_starts(table(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, slow(rows)))


def test_repeated_rows_are_turns_each(spark):
    rows = [(0, 0, "user", "a"), (0, 0, "user", "a"), (20, 0, "user", "a")]
    got = {(r.depth, r.n_convs) for r in trie.shared_starts(table(spark, rows)).collect()}
    assert got == {(r[1], r[3]) for r in slow(rows)} == {(0, 2), (1, 2), (2, 1)}


def test_an_empty_table_has_no_nodes(spark):
    assert trie.shared_starts(table(spark, [])).count() == 0
    assert trie.shared_starts(table(spark, [(None, 0, "user", "lost")])).count() == 0
