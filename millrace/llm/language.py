"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces, by the forward algorithm; a
text's is the product over its words. Piece probabilities are learnt by expectation
maximisation over the word types of a bounded sample of each language's texts. Words are
scored once per batch and type, all languages at a time, in arrays of words of one length.
Words of any length are learnt from and scored: where a script has no spaces, a whole line
is one word. Long ones go in windows, so that memory does not grow with pieces times length.

The score is the posterior of the predicted language. Texts that are null or have no
letter get ``und`` and score 0; so do all texts if nothing was learnt. Ties go to the
language that comes first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.kneser_ney import remainder
from millrace.llm.words import BASE, U64, Texts, Words, mix, pieces, sum_by, texts_of, words_of
from millrace.session import materialise

#: Texts of each language that are learnt from, about.
SAMPLE = 2000
ROUNDS = 3
#: Characters of the longest piece of the 32k model; each vocabulary has its own ``longest``.
LONGEST = 16
SMOOTHED = 0.01
#: Probability of a character that is no piece, the same for all languages.
UNKNOWN = 1e-9
#: Characters times languages that are looked at in one go; longer words go in windows.
CELLS = 1 << 16
#: Word types that are learnt from at a time.
TYPES = 50_000
#: Probabilities of word types, one for each language, that a task remembers.
REMEMBERED = 4_000_000
START = "▁"


class Vocabulary:
    """Sorted hashes of the pieces, how many characters the longest has, and which leading
    bits of the hashes occur at all."""

    def __init__(self, hashes: np.ndarray, longest: int) -> None:
        self.hashes, self.longest = hashes, longest
        self.some = np.zeros(1 << 20, bool)
        self.some[hashes >> U64(44)] = True

    def ids(self, hashed: np.ndarray) -> np.ndarray:
        """Place of each piece; the number of pieces where there is none."""
        out = np.full(len(hashed), len(self.hashes))
        at = np.flatnonzero(self.some[hashed >> U64(44)])
        place = np.minimum(np.searchsorted(self.hashes, hashed[at]), len(self.hashes) - 1)
        out[at] = np.where(self.hashes[place] == hashed[at], place, len(self.hashes))
        return out


def rolled(characters: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Hash of pieces that go on by one character each, not yet scrambled."""
    characters = characters.astype(U64) + U64(1)
    return characters if before is None else before * U64(BASE) + characters


def vocabulary_of(path: str) -> Vocabulary:
    """The pieces of a public model file, in lower case."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {
        model.id_to_piece(i).lower() for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    hashed = []
    for piece in sorted(found - {""}):
        h = None
        for c in piece:
            h = rolled(np.array([ord(c)]), h)
        hashed.append(mix(h))
    return Vocabulary(np.unique(np.concatenate(hashed)), max(map(len, found)))


def by_length(words: list[str], cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and characters of the words of each length, the start mark included, in parts
    of about ``cells`` characters and one word at least: a row per character, a column per word."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        rows = max(1, cells // (n + 1))
        for low in range(0, len(at), rows):
            part = at[low : low + rows]
            text = "".join(START + words[i] for i in part.tolist())
            characters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            yield part, np.ascontiguousarray(characters.reshape(len(part), n + 1).T)


def piece_ids(characters: np.ndarray, vocabulary: Vocabulary, low: int, high: int) -> np.ndarray:
    """The pieces that start at the places ``low`` to ``high``, by place, length and word."""
    n, w = characters.shape
    out = np.full((high - low, min(vocabulary.longest, n), w), len(vocabulary.hashes))
    h = None
    for k in range(min(out.shape[1], n - low)):
        stop = min(high, n - k)
        h = rolled(characters[low + k : stop + k], None if h is None else h[: stop - low])
        out[: stop - low, k] = vocabulary.ids(mix(h).ravel()).reshape(h.shape)
    return out


def steps(ids: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The probabilities of pieces, a column per language behind the places, lengths and words."""
    out = p[ids]
    out[:, 0][ids[:, 0] == len(p) - 1] = UNKNOWN
    return out


def endings(characters: np.ndarray, vocabulary: Vocabulary, p: np.ndarray, window: int) -> Iterator[np.ndarray]:
    """Window by window, probabilities of the pieces that end at each place, the longest first."""
    n, w = characters.shape
    longest = min(vocabulary.longest, n)
    for low in range(0, n, window):
        high = min(n, low + window)
        begin = max(0, low - longest + 1)
        started = steps(piece_ids(characters, vocabulary, begin, high), p)
        out = np.zeros((high - low, longest, w, p.shape[1]))
        for k in range(longest):
            first = max(low, k)
            out[first - low :, longest - 1 - k] = started[first - k - begin : high - k - begin, k]
        yield out


def beginnings(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Logarithms of the sums over the segmentations of each beginning, for each of the
    ``blocks`` of probabilities of the pieces that end at a place. Only as many sums as a
    piece is long are kept; a word and language of small ones is brought to a scale of its own."""
    last = scale = None
    for block in blocks:
        m, longest, *rest = block.shape
        block = block.reshape(m, longest, -1)
        if last is None:
            last, scale = np.zeros((longest, block.shape[2])), np.zeros(block.shape[2])
            last[-1] = 1
        sums = np.concatenate([last, np.empty((m, block.shape[2]))])
        out, scales = np.empty((m, block.shape[2])), np.empty((m, block.shape[2]))
        for t in range(m):
            total = np.einsum("kx,kx->x", sums[t : t + longest], block[t], out=sums[t + longest])
            out[t], scales[t] = total, scale
            if total.min() < 1e-100:
                small = total < 1e-100
                sums[t + 1 : t + 1 + longest] *= np.where(small, 1e100, 1.0)
                scale = scale - np.where(small, 100 * np.log(10), 0.0)
        last = sums[m:]
        yield (np.log(np.maximum(out, 1e-300)) + scales).reshape(m, *rest)


def log_probabilities(words: list[str], vocabulary: Vocabulary, p: np.ndarray) -> np.ndarray:
    """Natural logarithms of the words' probabilities, a column per language. ``p``: a row
    per piece and one of zeros, a column per language."""
    out = np.zeros((len(words), p.shape[1]))
    cells = max(1, CELLS // p.shape[1])
    for at, characters in by_length(words, cells):
        for logs in beginnings(endings(characters, vocabulary, p, max(vocabulary.longest, cells))):
            out[at] = logs[-1]
    return out


def expected(words: list[str], counts: np.ndarray, vocabulary: Vocabulary, p: np.ndarray) -> np.ndarray:
    """How often each piece is expected in the words, over all their segmentations, by one
    language's probabilities."""
    out = np.zeros(len(vocabulary.hashes) + 1)
    column = np.append(p, 0.0)[:, None]
    window = max(vocabulary.longest, CELLS)
    for at, characters in by_length(words, CELLS):
        n, w = characters.shape
        lows = range(0, n, window)

        def ids_from(low: int) -> np.ndarray:
            return piece_ids(characters, vocabulary, low, min(n, low + window))  # noqa: B023

        backwards = (steps(ids_from(low), column)[::-1, ::-1] for low in reversed(lows))
        start = np.zeros((1, w))
        alpha = np.concatenate([start, *(x[:, :, 0] for x in beginnings(endings(characters, vocabulary, column, window)))])
        beta = np.concatenate([start, *(x[:, :, 0] for x in beginnings(backwards))])[::-1]
        for low in lows:
            ids = ids_from(low)
            share = steps(ids, column)[..., 0]
            for k in range(ids.shape[1]):
                stop = max(low, min(low + len(ids), n - k))
                share[: stop - low, k] *= np.exp(alpha[low:stop] + beta[low + k + 1 : stop + k + 1] - alpha[n]) * counts[at]
            out += np.bincount(ids.ravel(), share.ravel(), len(out))
    return out[:-1]


class Types(NamedTuple):
    """A batch's word types by their sorted hashes, and for each word its type."""

    texts: Texts
    words: Words
    hashes: np.ndarray
    first: np.ndarray
    at: np.ndarray

    def strings(self, which: np.ndarray) -> list[str]:
        """Some of the types, in lower case."""
        data, first = self.texts.data.tobytes(), self.first[which]
        starts, ends = self.words.starts[first].tolist(), self.words.ends[first].tolist()
        return [data[a:b].decode("utf-8", "replace").lower() for a, b in zip(starts, ends, strict=True)]


def types_of(batch: pa.RecordBatch) -> Types:
    texts = texts_of(batch["text"])
    words = words_of(texts)
    return Types(texts, words, *np.unique(words.hashes, return_index=True, return_inverse=True))


class Remembered:
    """Logarithms of the word types met last, by sorted hashes."""

    def __init__(self, languages: int) -> None:
        self.hashes, self.logs = np.zeros(0, U64), np.zeros((0, languages))

    def of(self, types: Types, model: Model) -> np.ndarray:
        """The logarithms of all types of a batch; only those not met before are worked out."""
        out = np.zeros((len(types.hashes), self.logs.shape[1]))
        known = np.zeros(len(out), bool)
        if len(self.hashes):
            place = np.minimum(np.searchsorted(self.hashes, types.hashes), len(self.hashes) - 1)
            known = self.hashes[place] == types.hashes
            out[known] = self.logs[place[known]]
        fresh = np.flatnonzero(~known)
        out[fresh] = log_probabilities(types.strings(fresh), model.vocabulary, model.p)
        if (len(self.hashes) + len(fresh)) * self.logs.shape[1] > REMEMBERED:
            self.hashes, self.logs = types.hashes, out
        else:
            hashes = np.concatenate([self.hashes, types.hashes[fresh]])
            order = np.argsort(hashes, kind="stable")
            self.hashes, self.logs = hashes[order], np.concatenate([self.logs, out[fresh]])[order]
        return out


class Model(NamedTuple):
    languages: list[str]
    vocabulary: Vocabulary
    p: np.ndarray


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches, several at a time: each word length of a batch costs a pass of its own."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """About ``sample`` texts of each language, by a hash of the id; all if there are fewer."""
    rows = docs.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    many = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_many"))  # a row per language
    share = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30)) / (1 << 30)
    return rows.join(F.broadcast(many), "lang").where(share < F.lit(sample) / F.col("_many")).select("lang", "text")


def train(docs: DataFrame, path: str, sample: int = SAMPLE, rounds: int = ROUNDS) -> Model:
    """Learn from ``docs.text`` and ``docs.lang``; ``path`` names the vocabulary's file, read
    by the driver."""
    vocabulary = vocabulary_of(path)
    size = len(vocabulary.hashes)

    def count(batches):
        for batch in batches:
            for piece in pieces(batch):
                types = types_of(piece)
                names = np.array(piece["lang"].to_pylist(), object)
                owner = np.repeat(names, np.diff(types.words.docs))
                for lang in set(names):
                    which, counts = np.unique(types.at[owner == lang], return_counts=True)
                    yield pa.record_batch({
                        "lang": pa.array([lang] * len(which), pa.string()),
                        "word": pa.array(types.strings(which), pa.string()), "n": pa.array(counts, pa.int64()),
                    })

    counted = sampled(docs, sample).mapInArrow(count, "lang string, word string, n long")
    types = materialise(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    languages = sorted(row.lang for row in types.select("lang").distinct().collect())  # a row per language
    p = np.full((size, len(languages)), 1.0 / size)
    for _ in range(rounds if languages else 0):
        sent = docs.sparkSession.sparkContext.broadcast((vocabulary, languages, p))

        def expect(batches):
            vocabulary, languages, p = sent.value
            totals: dict[str, np.ndarray] = {}
            for table in gathered(batches, TYPES):
                names = np.array(table["lang"].to_pylist(), object)
                words, counts = np.array(table["word"].to_pylist(), object), table["n"].to_numpy()
                for lang in set(names):
                    mine = names == lang
                    more = expected(words[mine].tolist(), counts[mine], vocabulary, p[:, languages.index(lang)])
                    totals[lang] = totals.get(lang, 0) + more
            for lang, total in totals.items():
                yield pa.record_batch({"lang": pa.array([lang]), "expected": pa.array([total.tobytes()], pa.binary())})

        def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py()) for x in table["expected"])
            return pa.table({"lang": [key[0].as_py()], "expected": pa.array([total.tobytes()], pa.binary())})

        parts = types.mapInArrow(expect, "lang string, expected binary")
        for row in parts.groupBy("lang").applyInArrow(add, "lang string, expected binary").collect():  # a row per language
            found = np.frombuffer(row.expected) + SMOOTHED
            p[:, languages.index(row.lang)] = found / found.sum()
    return Model(languages, vocabulary, np.vstack([p, np.zeros(len(languages))]))


LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def lettered(texts: Texts) -> np.ndarray:
    """Whether each text has a letter; texts without an ASCII one are decoded to see."""
    out = sum_by(LETTER[texts.data].astype(np.int64), texts.offsets) > 0
    for i in np.flatnonzero(~out).tolist():
        data = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()
        out[i] = any(c.isalpha() for c in data.decode("utf-8", "replace"))
    return out


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, lang_pred and score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # pieces times languages

    def run(batches):
        model = sent.value
        remembered = Remembered(len(model.languages))
        for batch in batches:
            for piece in pieces(batch):
                names, scores = np.full(piece.num_rows, "und", object), np.zeros(piece.num_rows)
                types = types_of(piece)
                if model.languages:
                    logs = remembered.of(types, model)[types.at]
                    total = np.stack([sum_by(logs[:, k], types.words.docs) for k in range(len(model.languages))], 1)
                    best = total.argmax(1)
                    posterior = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                    known = lettered(types.texts)
                    names[known] = np.array(model.languages, object)[best[known]]
                    scores[known] = posterior[known]
                yield pa.record_batch({
                    "doc_id": piece["doc_id"], "lang_pred": pa.array(names.tolist(), pa.string()), "score": pa.array(scores, pa.float64())
                })

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, lang_pred string, score double")


def identified(docs: DataFrame, path: str, folds: int = 3, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out (crc32(doc_id) mod ``folds`` is 1: never learnt
    from), lang_pred and score."""
    found = predicted(docs, train(docs.where(remainder(folds) != 1), path, sample))
    return found.select("doc_id", (remainder(folds) == 1).alias("held_out"), "lang_pred", "score")
