"""Benchmark decontamination by greedy string tiling.

Words shared by a document and a benchmark item as runs (seeds) bring the two together.
Then the longest runs that neither side has given away yet are marked, again and again,
found by running Karp-Rabin hashes over windows of falling length, until no run of the
least length is left. The share of the item's words that are marked is its coverage; it
doesn't depend on the order of the passages, so shuffled sentences are caught too.

Words are runs of bytes other than white space and ASCII marks, A-Z as a-z. The benchmark
is a query set: it streams through the driver in blocks of bounded size, each sent to the
tasks and held against all documents in a pass without a shuffle. Items without words,
and null or empty texts, match nothing; items shorter than the least run must be matched
whole. Repeated documents or items give repeated rows.
"""

from __future__ import annotations

import heapq
import string
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import BASE, SPACES, U64, mix, pieces, rows_of, texts_of, windows, words_of

#: Words of the shortest run that counts.
LEAST = 3
#: Share of an item's words from which a document has it.
COVERAGE = 0.6
#: Bytes of items that are sent to the tasks at once; a longer item goes alone.
BLOCK_BYTES = 2 << 20
SEPARATORS = SPACES.copy()
SEPARATORS[list(string.punctuation.encode())] = True


class Items(NamedTuple):
    """Benchmark items of one block: ids, word hashes, and the seeds of each length as
    sorted hashes with the item and place of each."""

    ids: list
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    filters: dict[int, np.ndarray]


def items_of(ids: list, texts: list[str | None], least: int) -> Items:
    words = words_of(texts_of(pa.array(texts, pa.string())), SEPARATORS)
    each = [words.hashes[a:b] for a, b in zip(words.docs, words.docs[1:], strict=False)]
    seeds, filters = {}, {}
    for size in sorted({min(least, len(w)) for w in each} - {0}):
        rolled, offsets = windows(words.hashes, words.docs, size)
        owner = rows_of(offsets)
        place = np.arange(len(rolled)) - offsets[owner]
        mine = np.array([min(least, len(w)) == size for w in each])[owner]
        order = np.argsort(rolled[mine], kind="stable")
        seeds[size] = tuple(x[mine][order] for x in (rolled, owner, place))
        filters[size] = np.zeros(1 << 20, bool)
        filters[size][rolled[mine] >> U64(44)] = True
    return Items(ids, each, seeds, filters)


class Tile(NamedTuple):
    item_start: int
    doc_start: int
    length: int


def run_starts(item: np.ndarray, doc: np.ndarray, places: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``least`` common words begin that do not go on to the left: places of both
    sides with the same seed and different words before it. Only these are listed, not all
    places with one seed, so a word repeated over and over has few."""
    def seeds(words: np.ndarray) -> np.ndarray:
        return windows(words, np.array([0, len(words)]), least)[0]

    def before(words: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(at > 0, words[at - 1], 0)

    mine, other = seeds(item), seeds(doc)[places]
    order = np.lexsort((before(doc, places), other))
    places, other = places[order], other[order]
    last = before(doc, places)
    starts = [np.zeros((2, 0), np.int64)]
    low, high = np.searchsorted(other, mine), np.searchsorted(other, mine, "right")
    for i in np.flatnonzero(high > low).tolist():
        a, b = low[i], high[i]
        if i:  # all but those after the same word, and the document's first word
            c, d = a + np.searchsorted(last[a:b], item[i - 1]), a + np.searchsorted(last[a:b], item[i - 1], "right")
            j = np.concatenate([places[a:c], places[d:b], places[c:d][places[c:d] == 0]])
        else:
            j = places[a:b]
        starts.append(np.stack([np.full(len(j), i), j]))
    i, j = np.concatenate(starts, 1)
    return i, j


def run_lengths(item: np.ndarray, doc: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words agree from each pair of places on: Karp-Rabin hashes of windows, each
    length's made from those of half of it, are compared from the longest down."""
    hashed = [(item, doc)]
    while 2 << len(hashed) <= 2 * min(len(item), len(doc)):
        half, top = 1 << (len(hashed) - 1), U64(pow(BASE, 1 << (len(hashed) - 1), 1 << 64))
        hashed.append(tuple(x[:-half] * top + mix(x[half:]) for x in hashed[-1]))
    length = np.zeros(len(i), np.int64)
    for k in range(len(hashed) - 1, -1, -1):
        a, b = hashed[k]
        fits = (i + length < len(a)) & (j + length < len(b))
        at = np.flatnonzero(fits)
        same = a[i[at] + length[at]] == b[j[at] + length[at]]
        length[at[same]] += 1 << k
    return length


def tiles(item: np.ndarray, doc: np.ndarray, places: list[int], least: int) -> list[Tile]:
    """Greedy string tiling of two word sequences; ``places`` are the words of the document
    at which a run of ``least`` words of the item begins. Of the longest runs that are free
    the first in the item, then in the document, is marked; of one that lost words to a
    longer run, what is left goes on."""
    i, j = run_starts(item, doc, np.asarray(places, np.int64), least)
    length = run_lengths(item, doc, i, j)
    runs = list(zip((-length).tolist(), i.tolist(), j.tolist(), strict=True))
    heapq.heapify(runs)
    item_used, doc_used = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    found: list[Tile] = []
    left = len(item)
    while runs and left >= least:
        k, i, j = heapq.heappop(runs)
        used = item_used[i : i - k] | doc_used[j : j - k]
        if not used.any():
            found.append(Tile(i, j, -k))
            item_used[i : i - k] = doc_used[j : j - k] = True
            left += k
            continue
        cuts = np.flatnonzero(np.diff(np.concatenate([[True], used, [True]])))
        for a, b in zip(cuts[::2].tolist(), cuts[1::2].tolist(), strict=True):
            if b - a >= least:
                heapq.heappush(runs, (a - b, i + a, j + a))
    return found


def matches(batch: pa.RecordBatch, items: Items, coverage: float) -> list[tuple[int, int, int, list[Tile]]]:
    """Row, item, covered words and tiles of each pair that reaches the coverage."""
    words = words_of(texts_of(batch["text"]), SEPARATORS)
    out = []
    for size, (seeds, owners, starts) in items.seeds.items():
        rolled, offsets = windows(words.hashes, words.docs, size)
        at = np.flatnonzero(items.filters[size][rolled >> U64(44)])
        low = np.searchsorted(seeds, rolled[at], "left")
        times = np.searchsorted(seeds, rolled[at], "right") - low
        at, low, times = at[times > 0], low[times > 0], times[times > 0]
        if not len(at):
            continue
        # one entry per seed of an item and document that has it, however often
        doc = np.searchsorted(offsets, at, "right") - 1
        kinds, first = np.unique(doc * len(seeds) + low, return_index=True)
        low_of, times_of = kinds % len(seeds), times[first]
        each = np.repeat(low_of - np.cumsum(times_of) + times_of, times_of) + np.arange(times_of.sum())
        both = np.repeat(kinds // len(seeds), times_of) * len(items.ids) + owners[each]
        # no tile reaches a word of the item outside its shared seeds
        width = int(max(len(w) for w in items.words)) + 1
        cover = np.unique((both * width + starts[each])[:, None] + np.arange(size))
        pair, words_met = np.unique(cover // width, return_counts=True)
        lengths = np.array([len(w) for w in items.words])[pair % len(items.ids)]
        for p in pair[words_met >= coverage * lengths].tolist():
            row, item = divmod(p, len(items.ids))
            a, b = np.searchsorted(doc, [row, row + 1])
            own = np.isin(rolled[at[a:b]], seeds[owners == item])
            begin = int(words.docs[row])
            found = tiles(items.words[item], words.hashes[begin : words.docs[row + 1]], at[a:b][own] - offsets[row], size)
            covered = sum(t.length for t in found)
            if covered >= coverage * len(items.words[item]):
                out.append((row, item, covered, found))
    return out


def blocks_of(benchmark: DataFrame, least: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks, one block in the driver at a time."""
    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator(prefetchPartitions=False):
        ids.append(row.item_id)
        texts.append(row.text)
        size += len((row.text or "").encode())
        if size >= block_bytes:
            yield items_of(ids, texts, least)
            ids, texts, size = [], [], 0
    if ids:
        yield items_of(ids, texts, least)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """One row per document and item of which the document covers enough: doc_id, item_id,
    n_item_words, n_covered, coverage and the tiles. Clean documents have no row."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = (
        "doc_id long, item_id long, n_item_words int, n_covered int, coverage double, "
        "tiles array<struct<item_start:int,doc_start:int,length:int>>"
    )
    kind = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item_words", pa.int32()), ("n_covered", pa.int32()),
        ("coverage", pa.float64()),
        ("tiles", pa.list_(pa.struct([(name, pa.int32()) for name in Tile._fields]))),
    ])

    def against(items: Items) -> DataFrame:
        sent = spark.sparkContext.broadcast(items)

        def run(batches):
            for batch in batches:
                for piece in pieces(batch):
                    ids = piece["doc_id"].to_pylist()
                    rows = [
                        {
                            "doc_id": ids[row], "item_id": sent.value.ids[item], "n_item_words": (n := len(sent.value.words[item])),
                            "n_covered": covered, "coverage": covered / n, "tiles": [t._asdict() for t in found],
                        }
                        for row, item, covered, found in matches(piece, sent.value, coverage)
                    ]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, kind)

        return slim.mapInArrow(run, schema)

    found = [against(items) for items in blocks_of(benchmark, least)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """The rows of ``docs``, with all their columns, that cover no item."""

    def without(rest: DataFrame, items: Items) -> DataFrame:
        sent = rest.sparkSession.sparkContext.broadcast(items)

        def run(batches):
            for batch in batches:
                for piece in pieces(batch):
                    keep = np.ones(piece.num_rows, bool)
                    keep[[row for row, *_ in matches(piece, sent.value, coverage)]] = False
                    yield piece.filter(pa.array(keep))

        return rest.mapInArrow(run, rest.schema)

    return reduce(without, blocks_of(benchmark, least), docs)
