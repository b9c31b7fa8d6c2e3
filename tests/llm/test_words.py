import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.statistics import counts, exact_words
from millrace.llm.words import pieces, texts_of, windows, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans({c: c + 32 for c in range(65, 91)})
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é日\n\t .#|" + " ", max_size=60)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_expression(texts):
    words = words_of(texts_of(pa.array(texts, pa.string())))
    seen = {}
    for i, text in enumerate(texts):
        expected = WORD.findall((text or "").translate(ASCII))
        found = words.hashes[words.docs[i] : words.docs[i + 1]].tolist()
        assert len(found) == len(expected)
        for word, h in zip(expected, found, strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def slow_counts(text):
    words = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n#|", max_size=80), min_size=1, max_size=5))
def test_counts_match_plain_code(texts):
    found = texts_of(pa.array(texts, pa.string()))
    got = counts(found, exact_words(found))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert list(zip(*(got[n].tolist() for n in names), strict=True)) == [slow_counts(t) for t in texts]


def test_pieces_keep_every_row():
    batch = pa.record_batch({"text": pa.array(["a" * n for n in (5, 0, 30, 1, 1)] + [None])})
    cut = list(pieces(batch, limit=7))
    assert [t for p in cut for t in p["text"].to_pylist()] == batch["text"].to_pylist()
    assert max(p.num_rows for p in cut) < 6


def test_windows_stay_within_their_text():
    words = words_of(texts_of(pa.array(["a b c", "b c", None, "a b"])))
    rolled, offsets = windows(words.hashes, words.docs, 2)
    assert offsets.tolist() == [0, 2, 3, 3, 4]
    assert rolled[0] == rolled[3] and rolled[1] == rolled[2] and len(np.unique(rolled)) == 2
