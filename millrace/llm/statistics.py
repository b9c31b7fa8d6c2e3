"""Numbers about whole texts, by array operations over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import BASE, U64, Texts, Words, hashes, mix, pieces, rows_of, spans, sum_by, texts_of, windows

#: Words hashed here keep their case.
EXACT = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
NOT_NEWLINE = np.zeros(256, bool)
NOT_NEWLINE[0x0A] = True
REPEAT_WINDOW = 8


def table_of(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


SYMBOLS = table_of(b"#*$%&|<>")
UPPER = table_of(bytes(range(ord("A"), ord("Z") + 1)))
DIGITS = table_of(b"0123456789")
MARKS = table_of(b".,;:!?'\"()-")
STOPS = table_of(b".!?")
CODE_POINT = np.ones(256, bool)
CODE_POINT[0x80:0xC0] = False


def exact_words(texts: Texts) -> Words:
    starts, ends = spans(texts)
    return Words(hashes(texts.data, starts, ends, EXACT), starts, ends, np.searchsorted(starts, texts.offsets))


def of_text(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Keys told apart by the text they belong to."""
    return mix(keys + mix(rows_of(offsets).astype(U64) + U64(1)))


def distinct_by(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many different keys each text has."""
    own = rows_of(offsets)
    _, first = np.unique(of_text(keys, offsets), return_index=True)
    return np.bincount(own[first], minlength=len(offsets) - 1)


def repeated_words(words: Words, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Words within windows of ``size`` words that their text has twice or more."""
    rolled, offsets = windows(words.hashes, words.docs, size)
    change = np.zeros(len(words.hashes) + 1, np.int64)
    if len(rolled):
        _, at, times = np.unique(of_text(rolled, offsets), return_inverse=True, return_counts=True)
        again = np.flatnonzero(times[at] > 1)
        begin = again + (words.docs[:-1] - offsets[:-1])[rows_of(offsets)[again]]
        np.add.at(change, begin, 1)
        np.add.at(change, begin + size, -1)
    return sum_by((np.cumsum(change[:-1]) > 0).astype(np.int64), words.docs)


def counts(texts: Texts, words: Words) -> dict[str, np.ndarray]:
    """The whole numbers that the rules of ``quality_rules`` look at, by text."""
    data, offsets = texts
    inside = np.zeros(len(data) + 1, np.int64)
    change = np.zeros(len(data) + 1, np.int8)
    np.add.at(change, words.starts, 1)
    np.add.at(change, words.ends, -1)
    in_word = np.cumsum(change[:-1]) > 0
    inside[1:] = np.cumsum(in_word)
    first, last = spans(texts, NOT_NEWLINE)
    full = inside[last] > inside[first]
    first, last = first[full], last[full]
    lines = np.searchsorted(first, offsets)
    return {
        "n_words": np.diff(words.docs),
        "word_chars": sum_by((in_word & CODE_POINT[data]).astype(np.int64), offsets),
        "n_symbols": sum_by(SYMBOLS[data].astype(np.int64), offsets),
        "n_dup_lines": np.diff(lines) - distinct_by(hashes(data, first, last, EXACT), lines),
        "n_repeat_words": repeated_words(words),
        "n_lines": np.diff(lines),
    }


def ratios(texts: Texts, words: Words, counted: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Statistics that don't grow with the text's length, except its logarithm; 0 for empty texts."""
    data, offsets = texts
    size = np.maximum(np.diff(offsets), 1)
    n = np.maximum(counted["n_words"], 1)
    chars = np.maximum(counted["word_chars"], 1)
    lines = np.maximum(counted["n_lines"], 1)
    length = words.ends - words.starts
    following = words.hashes[1:] == words.hashes[:-1]
    same = np.zeros(len(words.hashes), np.int64)
    same[1:] = following
    heads = words.docs[:-1][np.diff(words.docs) > 0]
    same[heads] = 0
    share = lambda table: sum_by(table[data].astype(np.int64), offsets) / size
    return {
        "log_words": np.log1p(counted["n_words"]),
        "word_length": chars / n * (counted["n_words"] > 0),
        "long_words": sum_by((length > 20).astype(np.int64), words.docs) / n,
        "short_words": sum_by((length < 3).astype(np.int64), words.docs) / n,
        "distinct_words": distinct_by(words.hashes, words.docs) / n,
        "same_as_last": sum_by(same, words.docs) / n,
        "symbols": counted["n_symbols"] / chars,
        "dup_lines": counted["n_dup_lines"] / lines,
        "repeat_words": counted["n_repeat_words"] / n,
        "line_words": np.log1p(counted["n_words"] / lines),
        "upper": share(UPPER),
        "digits": share(DIGITS),
        "marks": share(MARKS),
        "stops": share(STOPS),
        "not_ascii": sum_by((data > 127).astype(np.int64), offsets) / size,
        "pipes": share(table_of(b"|")),
        "braces": share(table_of(b"{}<>=/\\_")),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
RATIOS = (
    "log_words", "word_length", "long_words", "short_words", "distinct_words", "same_as_last", "symbols", "dup_lines",
    "repeat_words", "line_words", "upper", "digits", "marks", "stops", "not_ascii", "pipes", "braces",
)


def described(docs: DataFrame, label: bool = False) -> DataFrame:
    """doc_id and the statistics of each text, one row per row of ``docs``; with
    ``label`` also that column of ``docs``, a whole number."""
    also = ["label"] * label

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                texts = texts_of(piece["text"])
                words = exact_words(texts)
                yield pa.record_batch({name: piece[name] for name in ["doc_id", *also]} | ratios(texts, words, counts(texts, words)))

    schema = "doc_id long, " + "label int, " * label + ", ".join(f"{name} double" for name in RATIOS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *also, "text").mapInArrow(run, schema)


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """doc_id, text and the label of at most ``most`` labelled documents, chosen by a hash
    of the id. Only their ids, so at most ``most``, are sent to the tasks; texts stay put.
    Rows without a label are left out; repeated ids count once per row of ``docs``."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id")
