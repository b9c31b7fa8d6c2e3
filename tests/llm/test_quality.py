import math
import re

import numpy as np
import pytest

from millrace.llm import quality_rules, rule_ensemble
from millrace.llm.statistics import RATIOS, described

from .conftest import prose
from .test_words import slow_counts


def junk(i):
    return " ".join(w.upper() + "!!" if i % 2 else w + "$$$" for w in prose(i).split())


@pytest.fixture
def labelled(spark, make):
    docs = make([(i, junk(i) if i % 4 == 0 else prose(i), "en", "s") for i in range(240)])
    labels = spark.createDataFrame(
        [(i, 0 if i % 4 == 0 else 1, 0) for i in range(200)] + [(900, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    return docs, labels


def test_rules_find_junk_and_keep_prose(labelled):
    docs, labels = labelled
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality_rules.judged(docs, quality_rules.train(docs, labels)).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_counts(texts[r.doc_id])
        assert r.kept == (r.doc_id % 4 != 0) and 0 <= r.probability <= 1


def test_base_rules_decide_first(make, odd, empty, labelled, spark):
    docs, labels = labelled
    model = quality_rules.train(docs, labels)
    rows = {r.doc_id: r for r in quality_rules.judged(make([
        (1, " ".join(prose(1).split()[:19]), None, None), (2, " ".join(prose(2).split()[:20]), None, None),
        (3, prose(3, 30) + " " + prose(3, 30), None, None), (4, None, None, None),
    ]), model).collect()}
    assert [rows[i].base_failed for i in (1, 2, 3, 4)] == [True, False, True, True] and not rows[3].kept
    assert quality_rules.judged(odd, model).count() == odd.count()
    passing = quality_rules.passing(odd, model)
    assert passing.columns == odd.columns
    kept = [r.doc_id for r in quality_rules.judged(odd, model).where("kept").collect()]
    assert sorted(map(str, kept)) == sorted(str(r.doc_id) for r in passing.collect())
    assert quality_rules.judged(empty, model).count() == 0 and quality_rules.train(empty, labels) is None
    assert quality_rules.judged(docs, None).where("kept").count() == 240


def test_ensemble_scores_held_out_rows(labelled, odd, empty):
    docs, labels = labelled
    rows = rule_ensemble.quality_scores(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert held and len(rows) == 240 and all(r.predicted == (r.doc_id % 4 != 0) == (r.score >= 0.3) for r in held)
    again = rule_ensemble.quality_scores(odd, labels).collect()
    assert len(again) == odd.count() and all(0 <= r.score <= 1 for r in again)
    assert rule_ensemble.quality_scores(empty, labels).count() == 0
    assert {r.score for r in rule_ensemble.quality_scores(docs, labels.where("quality = 1")).collect()} == {0.5}


def test_labels_of_held_out_rows_are_never_read(labelled, spark):
    docs, labels = labelled
    turned = labels.withColumn("quality", rule_ensemble.F.when(rule_ensemble.remainder(5) == 0, 1 - rule_ensemble.F.col("quality")).otherwise(rule_ensemble.F.col("quality")))
    scores = lambda found: sorted((r.doc_id, r.score) for r in found.collect())
    assert scores(rule_ensemble.quality_scores(docs, labels)) == scores(rule_ensemble.quality_scores(docs, turned))


def test_paths_become_rules():
    tree = """DecisionTreeClassificationModel
  If (feature 0 <= 1.5)
   If (feature 2 > 0.5)
    Predict: 0.0
   Else (feature 2 <= 0.5)
    Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 1.0
"""
    assert rule_ensemble.paths(tree, ("a", "b", "c")) == [
        (("a", "<=", 1.5),), (("a", "<=", 1.5), ("c", ">", 0.5)), (("a", "<=", 1.5), ("c", "<=", 0.5)), (("a", ">", 1.5),),
    ]
    assert rule_ensemble.merged((("a", "<=", 3.0), ("a", "<=", 1.0), ("a", ">", 0.0))) == (("a", "<=", 1.0), ("a", ">", 0.0))


def test_statistics_of_empty_texts_are_zero(odd):
    rows = {r.doc_id: r for r in described(odd).collect()}
    assert all(rows[40][name] == 0 for name in RATIOS) and all(rows[41][name] == 0 for name in RATIOS)


def test_the_classifier_is_fitted_in_300_steps(monkeypatch):
    rng = np.random.default_rng(2)
    slots, labels = rng.integers(0, 40, 60 * 8), (rng.random(60) < 0.5).astype(float)
    fit = lambda: quality_rules.fitted(np.arange(60) * 8, slots, np.full(len(slots), 2.0, np.float32), labels)
    weights, bias = fit()
    monkeypatch.setattr(quality_rules, "STEPS", 300)
    longer, longer_bias = fit()
    assert np.array_equal(weights, longer) and bias == longer_bias


def slow_ratios(text):
    """The statistics by plain code."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [re.findall(r"[^\x20\x09-\x0D]+", line) for line in text.split("\n")]
    kept = [line for line, found in zip(text.split("\n"), lines, strict=True) if found]
    size, n, chars = max(len(text.encode()), 1), max(len(words), 1), max(sum(map(len, words)), 1)
    counted = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), slow_counts(text), strict=True))
    share = lambda marks: sum(c in marks for c in text) / size
    return {
        "log_words": math.log1p(len(words)), "word_length": chars / n if words else 0,
        "long_words": sum(len(w.encode()) > 20 for w in words) / n, "short_words": sum(len(w.encode()) < 3 for w in words) / n,
        "distinct_words": len(set(words)) / n, "same_as_last": sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        "symbols": counted["n_symbols"] / chars, "dup_lines": (len(kept) - len(set(kept))) / max(len(kept), 1),
        "repeat_words": counted["n_repeat_words"] / n, "line_words": math.log1p(len(words) / max(len(kept), 1)),
        "upper": share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": share("0123456789"), "marks": share(".,;:!?'\"()-"),
        "stops": share(".!?"), "not_ascii": sum(b > 127 for b in text.encode()) / size, "pipes": share("|"), "braces": share("{}<>=/\\_"),
    }


ODD_TEXTS = [
    "", "one", " \n\t ", "a a a b\nsame line\nsame line\n", "日本語 テキスト ☃ #x $y", "A | B {c} <d> = / \\ _ 12.5%! ok?", "w" * 30 + " x\n\nx",
    prose(1, 200), prose(2, 20) + "\n" + prose(2, 20), "MiXed Case MiXed case (well), so: \"it's\" - done.",
]


def test_statistics_equal_plain_counts(make):
    rows = described(make([(i, t, None, None) for i, t in enumerate(ODD_TEXTS)])).collect()
    assert len(rows) == len(ODD_TEXTS)
    for r in rows:
        assert {name: r[name] for name in RATIOS} == pytest.approx(slow_ratios(ODD_TEXTS[r.doc_id])), r.doc_id


def test_compiled_scores_equal_rules_evaluated_by_hand(labelled, make):
    docs, labels = labelled
    sample = described(docs.join(labels.selectExpr("doc_id", "quality AS label"), "doc_id"), label=True)
    intercept, rules = rule_ensemble.train(sample)
    assert rules and all(weight for weight, _ in rules)
    texts = {i: t for i, t in enumerate([*ODD_TEXTS, junk(4), junk(9), prose(7)])}
    found = described(make([(i, t, None, None) for i, t in texts.items()]))
    holds = {"<=": lambda a, b: a <= b, ">": lambda a, b: a > b}
    for r in found.select("*", rule_ensemble.compiled(intercept, rules).alias("score")).collect():
        met = [w for w, rule in rules if all(holds[sign](r[name], value) for name, sign, value in rule)]
        assert r.score == pytest.approx(1 / (1 + math.exp(-intercept - sum(met))))
