import zlib
from hashlib import sha256

import pytest

from millrace.llm import merkle

from .conftest import prose


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root, and each leaf's siblings level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([hashed(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    proofs = []
    for at in range(len(nodes)):
        proof = []
        for level in levels[:-1]:
            proof += [(k < at, level[k]) for k in (at ^ 1,) if k < len(level)] or [None]
            at //= 2
        proofs.append(proof)
    return levels[-1][0], proofs


def fold(node, proof):
    for step in proof:
        node = hashed(node) if step is None else hashed(step[1], node) if step[0] else hashed(node, step[1])
    return node


def leaf(row, more=0):
    n_chars = None if row.n_chars is None else row.n_chars + more
    parts = []
    for value in (row.doc_id, row.source, row.lang, n_chars, row.text):
        data = None if value is None else str(value)
        parts.append("-" if data is None else f"{len(data.encode())}:{data}")
    return hashed(*parts)


def slow(rows):
    groups = {}
    for row in rows:
        groups.setdefault("" if row.lang is None else "=" + row.lang, []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    order = sorted(groups, key=str.encode)
    trees = {k: tree([leaf(r) for r in groups[k]]) for k in order}
    root, above = tree([trees[k][0] for k in order])
    out = []
    for k, up in zip(order, above, strict=True):
        for row, proof in zip(groups[k], trees[k][1], strict=True):
            proof = proof + up
            changed = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 7 == 0
            found = fold(leaf(row, int(changed)), proof)
            out.append((row.doc_id, leaf(row), trees[k][0], root, hashed(*(s[1] for s in proof if s)), found, found == root))
    return out


def check(docs, bits):
    got = [tuple(r) for r in merkle.audited(docs, bits).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, slow(docs.collect())))


@pytest.mark.parametrize("bits", [1, 2, 3, merkle.BITS])
def test_proofs_are_those_of_the_whole_tree(odd, bits):
    check(odd.repartition(5), bits)


def test_one_language_and_one_row(make):
    check(make([(i, prose(i, 3), "en", "a") for i in range(65)]), 2)
    check(make([(7, "alone", None, None)]), 2)


def test_many_languages(make):
    check(make([(i, prose(i, 3), f"l{i % 23}é", "a") for i in range(70)]), 1)


def test_tampering_shows_and_only_there(make, spark):
    docs = make([(i, prose(i, 3), "en", "a") for i in range(200)])
    got = {r.doc_id: r.verified for r in merkle.audited(docs, 3).collect()}
    assert {i for i, ok in got.items() if not ok} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 0}


def test_an_empty_table_has_no_rows(empty):
    assert merkle.audited(empty).count() == 0


def test_witnesses_grow_as_siblings_complete():
    leaves = [sha256(bytes([i])).digest() for i in range(11)]
    for n in range(1, 12):
        frontier = merkle.Frontier()
        for node in leaves[:n]:
            frontier.append(node)
            assert [h for h, _, _ in frontier.open] == sorted({h for h, _, _ in frontier.open}, reverse=True)
        root = frontier.close()
        assert root.hex() == tree([x.hex() for x in leaves[:n]])[0]
        assert all(merkle.folded(x, bytes(w)) == root for x, w in zip(leaves, frontier.witnesses, strict=False))
