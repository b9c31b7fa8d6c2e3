import math

import numpy as np
import pytest

from millrace.llm import language
from millrace.llm.catalogue import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")
TEXTS = {
    "en": "the river and the garden were quiet when they came home that evening with some bread",
    "de": "der Fluss und die Gärten waren ruhig als sie am Abend mit etwas Brot nach Hause kamen",
    "fr": "la rivière et les jardins étaient calmes quand ils sont rentrés le soir avec du pain",
}


@pytest.fixture(scope="module")
def vocabulary():
    return language.vocabulary_of(PATH)


def hash_of(piece):
    h = None
    for c in piece:
        h = language.rolled(np.array([ord(c)]), h)
    return language.mix(h)


def slow(word, vocabulary, p):
    """The sum over all segmentations, each by recursion."""
    text = language.START + word

    def rest(i):
        if i == len(text):
            return 1.0
        total = 0.0
        for j in range(i + 1, min(len(text), i + language.LONGEST) + 1):
            at = int(vocabulary.ids(hash_of(text[i:j]))[0])
            known = at < len(vocabulary.hashes)
            total += (p[at] if known else language.UNKNOWN if j == i + 1 else 0) * rest(j)
        return total

    return rest(0)


def test_forward_sums_every_segmentation(vocabulary):
    rng = np.random.default_rng(3)
    p = rng.random((len(vocabulary.hashes) + 1, 2))
    p[-1] = 0
    words = ["the", "a", "garten", "日本", "é", "xqzj", "rivers"]
    got = language.log_probabilities(words, vocabulary, p)
    for k, word in enumerate(words):
        for lang in range(2):
            assert math.isclose(got[k, lang], math.log(slow(word, vocabulary, p[:, lang])), rel_tol=1e-9)


def test_expected_counts_are_those_of_all_segmentations(vocabulary):
    p = np.full(len(vocabulary.hashes), 0.01)
    found = language.expected(["the"], np.array([4.0]), vocabulary, p)
    step = 1e-6
    for piece in ("▁the", "▁t", "he"):
        at = int(vocabulary.ids(hash_of(piece))[0])
        up = p.copy()
        up[at] += step
        slope = (math.log(slow("the", vocabulary, [*up, 0])) - math.log(slow("the", vocabulary, [*p, 0]))) / step
        assert math.isclose(found[at], 4 * slope * p[at], rel_tol=1e-3)


def test_long_words_do_not_underflow(vocabulary):
    p = np.vstack([np.full((len(vocabulary.hashes), 1), 1e-9), [[0.0]]])
    assert np.isfinite(language.log_probabilities(["q" * 3000], vocabulary, p)).all()
    assert language.log_probabilities(["q" * 3000], vocabulary, p)[0, 0] < -3000


def test_held_out_texts_are_recognised(make):
    rows = [(i, " ".join(TEXTS[la].split()[i % 4 :] * 3), la, "s") for i, la in enumerate(["en", "de", "fr"] * 40)]
    found = {r.doc_id: r for r in language.identified(make(rows), PATH).collect()}
    assert any(r.held_out for r in found.values()) and not all(r.held_out for r in found.values())
    assert all(found[i].lang_pred == la and 0.5 < found[i].score <= 1 for i, _, la, _ in rows)


def test_odd_rows(make, odd, empty):
    rows = language.identified(odd, PATH).collect()
    assert len(rows) == odd.count()
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (40, 41, 42, 47)} == {("und", 0.0)}
    assert {r.lang_pred for r in rows} <= {"en", "de", "und"} and all(0 <= r.score <= 1 for r in rows)
    assert language.identified(empty, PATH).count() == 0
    nothing = language.identified(make([(1, "some text", None, None), (2, None, "en", None)]), PATH).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_the_vocabulary_says_how_long_its_pieces_are(vocabulary):
    assert vocabulary.longest == language.LONGEST
    assert int(vocabulary.ids(hash_of("▁administration"))[0]) < len(vocabulary.hashes)


def test_long_words_are_learnt_from(vocabulary, monkeypatch):
    rng = np.random.default_rng(5)
    p = rng.random(len(vocabulary.hashes)) ** 4
    p /= p.sum()
    words = ["".join(rng.choice(list("thegardnofi"), n)) for n in (3, 38, 39, 40, 41, 200, 200, 2500)]
    counts = np.arange(1.0, 9.0)
    whole = language.expected(words, counts, vocabulary, p)
    # each character is in one piece of each segmentation
    sizes = np.zeros(len(p))
    for word in words:
        text = language.START + word
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + vocabulary.longest) + 1):
                if (at := int(vocabulary.ids(hash_of(text[i:j]))[0])) < len(p):
                    sizes[at] = j - i
    assert math.isclose((whole * sizes).sum(), sum(c * (len(w) + 1) for c, w in zip(counts, words, strict=True)), rel_tol=1e-6)
    logs = language.log_probabilities(words, vocabulary, np.vstack([p[:, None], [[0.0]]]))
    monkeypatch.setattr(language, "CELLS", 100)
    assert np.allclose(language.expected(words, counts, vocabulary, p), whole, rtol=1e-6, atol=1e-12)
    assert np.allclose(language.log_probabilities(words, vocabulary, np.vstack([p[:, None], [[0.0]]])), logs, rtol=1e-9)


def test_a_language_far_behind_within_a_word_catches_up(vocabulary):
    p = np.full((len(vocabulary.hashes) + 1, 2), 1e-6)
    p[-1] = 0
    p[vocabulary.ids(hash_of("本")), 0] = p[vocabulary.ids(hash_of("日")), 1] = 0.5
    logs = language.log_probabilities(["本" * 300 + "日" * 400, "日" * 400], vocabulary, p)
    assert (logs.argmax(1) == 1).all() and math.isclose(logs[0, 1] - logs[0, 0], 100 * math.log(5e5), rel_tol=1e-2)


def test_languages_without_spaces_are_told_apart(make):
    rng = np.random.default_rng(7)
    often = {"ja": "日本人の学生は大", "zh": "中国人的学生在大"}
    rows = []
    for i in range(120):
        lang = ("ja", "zh")[i % 2]
        rows.append((i, "".join(rng.choice(list(often[lang]), 60 + i)), lang, "s"))
    found = {r.doc_id: r for r in language.identified(make(rows), PATH).collect()}
    assert [found[i].lang_pred for i, *_ in rows] == [la for _, _, la, _ in rows]
