"""Quality rules: hashed word and character n-gram logistic regression on top of counts.

A text fails the base rules for being short or repetitive. The others are judged by a
logistic regression over hashed word unigrams, word bigrams and byte 4-grams, each kind
as shares of its own total, trained on a bounded sample of labelled rows and calibrated
(Platt) on the part of that sample which the weights have not seen. Scoring adds up
weights over Arrow batches; the verdict is by a fixed threshold on the probability.

Null and empty texts have no word, fail the base rules and score as the bias alone.
Without labels of both kinds no model can be fitted: every text gets probability 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.statistics import counts, exact_words, labelled
from millrace.llm.words import BASE, U64, Texts, Words, mix, pieces, rows_of, sum_by, texts_of, windows

BITS = 16
CHARACTERS = 4
#: Labelled rows that the classifier is fitted on, at most.
SAMPLE = 4000
#: Texts with a lower probability of being good are rejected.
THRESHOLD = 0.3
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
STEPS, RATE, RIDGE, SCALE = 300, 0.1, 1e-5, 30.0
#: Bytes of text that are looked at in one go; arrays of 8 bytes each are made of them.
PIECE = 1 << 20


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -60, 60)))


def features(texts: Texts, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Slots of each kind of n-gram, and their offsets by text."""
    grams = np.zeros(max(len(texts.data) - CHARACTERS + 1, 0), U64)
    for k in range(CHARACTERS):
        grams = grams * U64(257) + texts.data[k : len(texts.data) - CHARACTERS + 1 + k if len(grams) else k]
    starts = np.minimum(texts.offsets, len(grams))
    stops = np.clip(texts.offsets[1:] - CHARACTERS + 1, starts[:-1], None)
    inside = np.zeros(len(grams) + 1, np.int8)
    np.add.at(inside, starts[:-1], 1)
    np.add.at(inside, np.minimum(stops, len(grams)), -1)
    grams = grams[np.cumsum(inside[:-1]) > 0]
    offsets = np.concatenate([[0], np.cumsum(np.minimum(stops, len(inside) - 1) - starts[:-1])])
    pairs, pair_offsets = windows(words.hashes, words.docs, 2)
    slot = lambda keys, kind: (mix(keys + U64(kind)) >> U64(64 - BITS)).astype(np.int32)
    return [(slot(words.hashes, 1), words.docs), (slot(pairs, 2), pair_offsets), (slot(grams * U64(BASE), 3), offsets)]


def raw_scores(model: Classifier, texts: Texts, words: Words) -> np.ndarray:
    total = np.full(len(texts.offsets) - 1, model.bias)
    for slots, offsets in features(texts, words):
        total += SCALE * sum_by(model.weights[slots], offsets) / np.maximum(np.diff(offsets), 1)
    return total


def sparse(texts: Texts, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text, its distinct slots and their values."""
    n = len(texts.offsets) - 1
    keys, values = [], []
    for slots, offsets in features(texts, words):
        found, times = np.unique(rows_of(offsets) << BITS | slots, return_counts=True)
        keys.append(found)
        values.append(SCALE * times / np.maximum(np.diff(offsets), 1)[found >> BITS])
    keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    values = np.bincount(at, np.concatenate(values), len(keys)).astype(np.float32)
    cuts = np.searchsorted(keys >> BITS, np.arange(n + 1))
    slots = (keys & ((1 << BITS) - 1)).astype(np.int32)
    return [(slots[a:b], values[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def fitted(starts: np.ndarray, slots: np.ndarray, values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam. The entries of a text follow each other, from
    ``starts`` on; every text has some."""
    n = len(labels)
    sizes = np.diff(starts, append=len(slots))
    weights, bias = np.zeros(1 << BITS), float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    first, second, step_b = np.zeros(1 << BITS), np.zeros(1 << BITS), 0.0
    for step in range(1, STEPS + 1):
        raw = np.add.reduceat(values * weights[slots], starts) + bias
        error = (1 / (1 + np.exp(-np.clip(raw, -60, 60))) - labels) / n
        slope = np.bincount(slots, values * np.repeat(error, sizes), 1 << BITS) + RIDGE * weights
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-7)
        step_b = 0.9 * step_b + error.sum()
        bias -= RATE * step_b
    return weights, bias


def platt(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibration, by Newton steps on softened labels."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([raw, np.ones(len(raw))], 1)
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -60, 60)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        at = at - np.linalg.solve(curve, x.T @ (p - target) + 1e-3 * (at - [1.0, 0.0]))
    return float(at[0]), float(at[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Classifier | None:
    """Fit on at most ``sample`` rows of ``labels.quality`` with whole texts. Their sparse
    features, bounded by ``sample``, meet in one task."""

    def extract(batches):
        for batch in batches:
            for piece in pieces(batch, limit=PIECE):
                texts = texts_of(piece["text"])
                found = sparse(texts, exact_words(texts))
                yield pa.record_batch({
                    "all": pa.array([0] * piece.num_rows, pa.int32()), "doc_id": piece["doc_id"], "label": piece["label"],
                    "slots": pa.array([s.tobytes() for s, _ in found], pa.binary()),
                    "shares": pa.array([v.tobytes() for _, v in found], pa.binary()),
                })

    def fit(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        # texts without any n-gram say nothing
        table = table.filter(pc.greater(pc.binary_length(table["slots"]), 0)).sort_by([("doc_id", "ascending")])
        goals = table["label"].to_numpy().astype(float)
        unseen = np.arange(len(goals)) % 4 == 3
        if len(set(goals[~unseen])) < 2:
            return pa.table({"weights": pa.array([], pa.binary()), "numbers": pa.array([], pa.list_(pa.float64()))})

        def entries(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            slots = [np.frombuffer(x.as_buffer(), np.int32) for x in part["slots"]]
            starts = np.cumsum([0, *(len(s) for s in slots[:-1])])
            values = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in part["shares"]])
            return starts, np.concatenate(slots).astype(np.int64), values

        weights, bias = fitted(*entries(table.filter(pa.array(~unseen))), goals[~unseen])
        slope, shift = 1.0, 0.0
        if len(set(goals[unseen])) > 1:
            starts, slots, values = entries(table.filter(pa.array(unseen)))
            slope, shift = platt(np.add.reduceat(values * weights[slots], starts) + bias, goals[unseen])
        return pa.table({"weights": [weights.tobytes()], "numbers": [[bias, slope, shift]]})

    schema = "all int, doc_id long, label int, slots binary, shares binary"
    found = (
        labelled(docs, labels, "quality", sample).mapInArrow(extract, schema)
        .groupBy("all").applyInArrow(fit, "weights binary, numbers array<double>")
    ).first()
    return Classifier(np.frombuffer(found.weights).copy(), *found.numbers) if found else None


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "probability double, base_failed boolean, kept boolean"
)


def verdicts(batch: pa.RecordBatch, model: Classifier | None, threshold: float) -> dict[str, np.ndarray]:
    """Counts, probability and verdict of each text of a batch."""
    texts = texts_of(batch["text"])
    words = exact_words(texts)
    found = counts(texts, words)
    n = found["n_words"]
    p = model.probability(raw_scores(model, texts, words)) if model else np.ones(len(n))
    failed = (n < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return {k: found[k] for k in names} | {"probability": p, "base_failed": failed, "kept": ~failed & (p >= threshold)}


def judged(docs: DataFrame, model: Classifier | None, threshold: float = THRESHOLD) -> DataFrame:
    """A row of counts, calibrated probability and verdict per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS weights

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=PIECE):
                yield pa.record_batch({"doc_id": piece["doc_id"]} | verdicts(piece, sent.value, threshold))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def passing(docs: DataFrame, model: Classifier | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are kept."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, limit=PIECE):
                yield piece.filter(pa.array(verdicts(piece, sent.value, threshold)["kept"]))

    return docs.mapInArrow(run, docs.schema)
