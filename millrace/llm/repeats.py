"""Substring de-duplication by suffix automata of reference shards.

A run of words that also occurs elsewhere is found by streaming texts through suffix
automata: the automaton of some stretches of text knows every run of words in them and how
often it occurs, and reading a text through it gives, at each word, the longest run ending
there that the stretches have (its matching statistics). Words that lie in a run of the
least length that occurs twice or more are removed, all occurrences of it alike.

The reference is the corpus itself, so holding each text against the automata of all shards
would square the work. Stretches and shards are therefore dealt out by seeds: each window
of the least length has a seed, the smallest hash of its shorter runs, and neighbouring
windows of one seed form a stretch. Equal windows have equal seeds, so a window can only
occur again in stretches of its own seed. Seeds that occur once are put aside; the other
stretches, equal ones once and with their number, are the references, cut by seed into
shards of bounded size, and each automaton is read by the stretches with its seeds only.
A seed with more stretches than a shard should hold is dealt out by whole windows instead:
each is a stretch with itself as the seed. So no seed, passage or group of copies makes a
large shard, and nothing is left out.

A null text has no words, and texts of fewer words than a window lose none. Texts are read
whole, of any length. Repeated rows, and texts repeated under other ids, count as
occurrences of their own, and every row gets its result. Words are told apart by 64-bit hashes
of their bytes. An empty table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.packing import packed, unpacked
from millrace.llm.words import BASE, BASE_INVERSE, U64, Texts, hashes, mix, pieces, powers, rows_of, spans, texts_of, windows
from millrace.session import materialise, working

#: Words of the shortest run that counts, and of the runs that seeds are hashes of.
LENGTH = 35
SEED = 12
#: Windows of a stretch at most: a text that repeats itself has the same seed all along.
STRETCH = 256
#: Words of a shard's stretches, about; windows of a seed from which it is dealt out by windows.
SHARD_WORDS = 1 << 17
SEED_WINDOWS = 1 << 15
#: A value per byte: unlike those of ``words``, also for capital letters.
EXACT = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


class Automaton:
    """The suffix automaton of several sequences, with the number of times that each of its
    runs occurs; a sequence of weight n counts as n."""

    def __init__(self, sequences: Sequence[Sequence[int]], weights: Sequence[int]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.times = [-1], [0], [0]
        for sequence, weight in zip(sequences, weights, strict=True):
            last = 0
            for word in sequence:
                last = self._extended(last, word)
                self.times[last] += weight
        order = np.argsort(np.array(self.length), kind="stable")[:0:-1].tolist()
        for state in order:
            self.times[self.link[state]] += self.times[state]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.times.append(0)
        return len(self.link) - 1

    def _clone(self, state: int, before: int, word: int) -> int:
        """A state of its own for the shorter runs of one, which ``before`` leads to."""
        clone = self._state(self.length[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = clone
        while before >= 0 and self.next[before].get(word) == state:
            self.next[before][word] = clone
            before = self.link[before]
        return clone

    def _extended(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:  # an earlier sequence begins the same
            return known if self.length[known] == self.length[last] + 1 else self._clone(known, last, word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            other = self.next[last][word]
            self.link[new] = other if self.length[other] == self.length[last] + 1 else self._clone(other, last, word)
        return new

    def statistics(self, sequence: Sequence[int]) -> Iterator[tuple[int, int]]:
        """At each word, the length of the longest run ending there that occurs in the
        automaton's sequences, and its state."""
        state = length = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield length, state

    def repeated(self, sequence: Sequence[int], least: int) -> list[tuple[int, int]]:
        """The maximal spans of the sequence that consist of runs of ``least`` words which
        occur twice or more."""
        out: list[tuple[int, int]] = []
        for at, (length, state) in enumerate(self.statistics(sequence)):
            if length < least:
                continue
            while self.length[self.link[state]] >= least:
                state = self.link[state]
            if self.times[state] > 1:
                start = at + 1 - least
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], at + 1)
                else:
                    out.append((start, at + 1))
        return out


def words_of(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and where each text's begin among them."""
    starts, ends = spans(texts)
    return hashes(texts.data, starts, ends, EXACT), np.searchsorted(starts, texts.offsets)


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - width + span], values[width - span :]) if span < width else values


def stretches(hashed: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Text, first window, number of windows, seed and name of each stretch, and how often it
    has the run that is its seed: a window can occur twice in one stretch, too."""
    short = min(SEED, length)
    count = np.maximum(np.diff(docs) - length + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(count)])
    if not offsets[-1]:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams, _ = windows(hashed, np.array([0, len(hashed)]), short)
    owner = rows_of(offsets)
    place = np.arange(offsets[-1]) - offsets[owner]
    seeds = least_of(grams, length - short + 1)[docs[owner] + place]
    new = np.ones(len(seeds), bool)
    new[1:] = (seeds[1:] != seeds[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    run = np.diff([*begins, len(seeds)])
    if run.max() > STRETCH:
        step = np.arange(len(seeds)) - np.repeat(begins, run)
        begins = np.flatnonzero(step % STRETCH == 0)
        run = np.diff([*begins, len(seeds)])
    first = docs[owner[begins]] + place[begins]
    width = run + length - short
    ends = np.cumsum(width)
    inside = np.arange(ends[-1]) + np.repeat(first - ends + width, width)
    times = np.add.reduceat(grams[inside] == np.repeat(seeds[begins], width), ends - width, dtype=np.int32)
    return owner[begins], place[begins], run, seeds[begins], names(hashed, first, first + run + length - 1), times


def names(hashed: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each run of words."""
    sums = np.zeros(len(hashed) + 1, U64)
    np.cumsum(hashed * powers(BASE, len(hashed)), out=sums[1:])
    return mix((sums[stops] - sums[starts]) * powers(BASE_INVERSE, len(hashed) + 1)[starts] + (stops - starts).astype(U64))


KEY = "a long, b long"
STRETCHES = f"{KEY}, at int, windows int, seed long, name long, times int"


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id and text with a key (``a``, ``b``) that only rows of equal id and text share."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.xxhash64(F.lit(1), text)).alias("a"),
        F.xxhash64(F.lit(2), text).alias("b"),
    )


def cut(texts: DataFrame, length: int) -> DataFrame:
    """The stretches of all texts, by text key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                owner, at, count, seeds, named, times = stretches(*words_of(texts_of(piece["text"])), length)
                owner = pa.array(owner)
                yield pa.record_batch({
                    "a": piece["a"].take(owner), "b": piece["b"].take(owner), "at": pa.array(at.astype(np.int32)),
                    "windows": pa.array(count.astype(np.int32)), "seed": _longs(seeds), "name": _longs(named),
                    "times": pa.array(times.astype(np.int32)),
                })

    return texts.select("a", "b", "text").mapInArrow(run, STRETCHES)


def cut_by_windows(texts: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Some stretches (by text key, first window and number of windows) as windows of their own."""
    lists = places.groupBy("a", "b").agg(F.collect_set(F.struct("at", "windows")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in unpacked(batch):
                hashed, docs = words_of(texts_of(piece["text"]))
                lists = piece["places"]
                owner = rows_of(lists.offsets.to_numpy() - lists.offsets[0].as_py())
                flat = lists.flatten()
                at, count = flat.field("at").to_numpy(), flat.field("windows").to_numpy()
                owner, step = np.repeat(owner, count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                at = np.repeat(at, count) + step
                first = docs[owner] + at
                named = names(hashed, first, first + length)
                owner = pa.array(owner)
                yield pa.record_batch({
                    "a": piece["a"].take(owner), "b": piece["b"].take(owner), "at": pa.array(at.astype(np.int32)),
                    "windows": pa.array(one := np.ones(len(at), np.int32)), "seed": _longs(mix(named)), "name": _longs(named),
                    "times": pa.array(one),
                })

    return packed(texts.select("a", "b", "text")).join(lists, ["a", "b"]).mapInArrow(run, STRETCHES)


def _again(found: DataFrame) -> DataFrame:
    """The stretches whose seed occurs again."""
    # written: a join of two plain shuffles is one whose hot keys Spark can split
    several = materialise(found.groupBy("seed").agg(F.sum("times").alias("_n")).where("_n > 1").select("seed"), "seeds-again")
    return found.join(several.hint("merge"), "seed", "left_semi").select(*(part.split()[0] for part in STRETCHES.split(", ")))


def _distinct(found: DataFrame) -> DataFrame:
    return found.groupBy("seed", "name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("a", "b", "at", "windows")).alias("one"))


def references(texts: DataFrame, distinct: DataFrame, length: int, shards: int) -> DataFrame:
    """The distinct stretches with their words, by shard."""
    shard = F.pmod(F.xxhash64("seed"), F.lit(shards)).cast("int")
    lists = distinct.groupBy("one.a", "one.b").agg(
        F.collect_list(F.struct(shard.alias("shard"), "seed", "name", "n", "one.at", "one.windows")).alias("parts")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in unpacked(batch):
                hashed, docs = words_of(texts_of(piece["text"]))
                lists = piece["parts"]
                owner = rows_of(lists.offsets.to_numpy() - lists.offsets[0].as_py())
                flat = lists.flatten()
                first = docs[owner] + flat.field("at").to_numpy()
                last = first + flat.field("windows").to_numpy() + length - 1
                sent = [hashed[i:j].tobytes() for i, j in zip(first.tolist(), last.tolist(), strict=True)]
                yield pa.record_batch({
                    **{name: flat.field(name) for name in ("shard", "seed", "name", "n")}, "words": pa.array(sent, pa.binary()),
                })

    # merged: the same plan for tables of every size
    once = packed(texts.select("a", "b", "text")).join(lists.hint("merge"), ["a", "b"]).dropDuplicates(["a", "b"])
    return once.mapInArrow(run, "shard int, seed long, name long, n long, words binary")


SPANS = "array<struct<start:int,stop:int>>"


def matched(stretched: DataFrame, length: int) -> DataFrame:
    """seed, name and the repeated spans of those stretches that have any: each shard's
    automaton is built, and read by its stretches."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(table: pa.Table) -> pa.Table:
        # words as small numbers: they are keys of many dictionaries
        seed, name, weights = (table[c].to_numpy() for c in ("seed", "name", "n"))
        found = [np.frombuffer(w.as_buffer(), U64) for w in table["words"]]
        _, small = np.unique(np.concatenate(found), return_inverse=True)
        cuts = np.cumsum([0, *map(len, found)])
        sequences = [small[i:j].tolist() for i, j in zip(cuts, cuts[1:], strict=False)]
        automaton = Automaton(sequences, weights.tolist())
        keep, out = [], []
        for i, sequence in enumerate(sequences):
            if repeats := automaton.repeated(sequence, length):
                keep.append(i)
                out.append([{"start": a, "stop": b} for a, b in repeats])
        return pa.table({"seed": seed[keep], "name": name[keep], "repeats": pa.array(out, kind)})

    return stretched.groupBy("shard").applyInArrow(run, f"seed long, name long, repeats {SPANS}")


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed_windows: int = SEED_WINDOWS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per text key with any: the spans of words (``start``, ``stop``) that occur elsewhere too."""
    texts, spark = keyed(docs), docs.sparkSession
    with working(spark):
        with working(spark):
            found = materialise(_again(materialise(cut(texts, length), "stretches")), "stretches-again", keep=True)
        distinct = materialise(_distinct(found), "stretch-names")
        sizes = distinct.groupBy("seed").agg(F.sum("one.windows").alias("_windows"))
        large = materialise(sizes.where(F.col("_windows") > seed_windows).select("seed"), "large-seeds")
        if not large.isEmpty():
            fine = materialise(cut_by_windows(texts, found.join(large, "seed", "left_semi"), length), "stretch-windows")
            rest = found.join(large, "seed", "left_anti").select(*fine.columns)
            found = materialise(rest.unionByName(_again(fine)), "stretches-again")
            distinct = materialise(_distinct(found), "stretch-names")
        words = distinct.agg(F.sum(F.col("one.windows") + (length - 1))).first()[0] or 0
        shards = max(1, -(-words // shard_words))
        marks = materialise(matched(references(texts, distinct, length, shards), length), "stretch-repeats")
        each = found.join(marks, ["seed", "name"]).select("a", "b", "at", F.explode("repeats").alias("r"))
        span = F.struct((F.col("at") + F.col("r.start")).alias("start"), (F.col("at") + F.col("r.stop")).alias("stop"))
        return materialise(each.groupBy("a", "b").agg(F.collect_set(span).alias("spans")), "repeated-spans", keep=True)


def without_repeats(docs: DataFrame, length: int = LENGTH, **sizes: int) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and the text of the words that stay,
    joined by single spaces."""
    marks = repeated_spans(docs, length, **sizes)
    rows = packed(keyed(docs)).join(marks.hint("merge"), ["a", "b"], "left").select("doc_id", "packed", "size", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in unpacked(batch):
                texts, counts, removed = [], array("q"), array("q")
                for text, spans in zip(piece["text"].to_pylist(), piece["spans"].to_pylist(), strict=True):
                    words = text.encode().split()  # at the white space of ASCII
                    counts.append(len(words))
                    if spans:
                        gone = np.zeros(len(words) + 1, np.int64)
                        for span in spans:
                            gone[span["start"]] += 1
                            gone[span["stop"]] -= 1
                        stay = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
                        words = [words[i] for i in stay]
                    removed.append(counts[-1] - len(words))
                    texts.append(b" ".join(words))
                yield pa.record_batch({
                    "doc_id": piece["doc_id"], "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                    "text": pa.array(texts, pa.binary()).cast(pa.string()),
                })

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, text string")
