"""Token-ID output: Re-Pair grammars over blocks of token ids, decoded at any place.

Documents are tokenized whole, in ascending order of their ids, and cut into blocks of
whole documents. In each block frequent pairs of ids are replaced by nonterminals, round
after round: a round counts the pairs, takes the frequent ones most frequent first, as
long as no two of them can overlap, and replaces all their occurrences. A block is one
binary value:

    magic "RPR1", then 32-bit little-endian: ids below which symbols are terminals, rules,
    sequence length, documents; then arrays of 32-bit numbers: left and right of each rule,
    expansion length of each rule, the sequence, and how many ids each document has.

The expansion lengths give the place of every symbol in the decoded stream without
decoding it, so a document, or any stretch of ids, is decoded from its own symbols only.

A null text is empty and has the end id alone. Documents with equal ids are ordered by
text. An empty table writes no block.
"""

from __future__ import annotations

import functools
import string
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.words import BASE, U64, hashes, mix, pieces, texts_of
from millrace.session import new_path

MAGIC = b"RPR1"
#: Ids gathered into a block before it is closed; a longer document makes a longer block.
BLOCK = 1 << 20
#: A pair is replaced if a block has it so often.
FREQUENT = 4
#: Text pieces whose ids a worker remembers, 40 bytes or so each, and the bytes of the longest.
REMEMBERED = 1_500_000
LONGEST = 200


class Block(NamedTuple):
    terminals: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    sequence: np.ndarray
    documents: np.ndarray

    def to_bytes(self) -> bytes:
        head = np.array([self.terminals, len(self.left), len(self.sequence), len(self.documents)], "<u4")
        return MAGIC + b"".join(x.astype("<u4").tobytes() for x in (head, *self[1:]))

    @staticmethod
    def from_bytes(data: bytes) -> Block:
        if data[:4] != MAGIC:
            raise ValueError("not a block of this format")
        terminals, rules, symbols, documents = np.frombuffer(data, "<u4", 4, 4).tolist()
        rest = np.frombuffer(data, "<u4", -1, 20)
        cuts = np.cumsum([rules, rules, rules, symbols])
        return Block(terminals, *np.split(rest, cuts))

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that the symbols stand for."""
        symbols = symbols.astype(np.int64)
        at = np.flatnonzero(symbols >= self.terminals)
        if len(at) <= len(self.left):
            return self._unfolded(symbols).astype("<u4")
        # many symbols: unfold each rule once, then copy the runs that they stand for
        rules = self._unfolded(np.arange(len(self.left)) + self.terminals).astype("<u4")
        sizes = self.lengths.astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        rule = symbols[at] - self.terminals
        width = np.ones(len(symbols), np.int64)
        width[at] = sizes[rule]
        place = np.cumsum(width) - width
        out = np.empty(place[-1] + width[-1], "<u4")
        alone = np.ones(len(symbols), bool)
        alone[at] = False
        out[place[alone]] = symbols[alone]
        run = width[at]
        step = np.arange(run.sum()) - np.repeat(np.cumsum(run) - run, run)
        out[np.repeat(place[at], run) + step] = rules[np.repeat(begins[rule], run) + step]
        return out

    def _unfolded(self, symbols: np.ndarray) -> np.ndarray:
        while len(at := np.flatnonzero(symbols >= self.terminals)):
            width = np.ones(len(symbols), np.int64)
            width[at] = 2
            place = np.cumsum(width) - width
            out = np.empty(place[-1] + width[-1], np.int64)
            out[place] = symbols
            rule = symbols[at] - self.terminals
            out[place[at]] = self.left[rule]
            out[place[at] + 1] = self.right[rule]
            symbols = out
        return symbols

    def widths(self) -> np.ndarray:
        """How many ids each symbol of the sequence stands for."""
        rules = self.sequence >= self.terminals
        out = np.ones(len(self.sequence), np.int64)
        out[rules] = self.lengths[self.sequence[rules] - self.terminals]
        return out

    def part(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the block, from the symbols that cover them."""
        ends = np.cumsum(self.widths())
        first, last = np.searchsorted(ends, [start, stop - 1], "right")
        if start >= stop:
            return np.zeros(0, "<u4")
        skipped = int(ends[first - 1]) if first else 0
        return self.expand(self.sequence[first : last + 1])[start - skipped : stop - skipped]


def compressed(ids: np.ndarray, documents: np.ndarray, terminals: int, frequent: int = FREQUENT) -> Block:
    """The block of a stream of ids. Rounds go on until no pair is frequent.

    A pair of old symbols never becomes more frequent, so after the first round only places
    beside new symbols, and those of pairs that were frequent and had to wait, are counted.
    """
    sequence, left, right = ids.astype(np.int32), [], []
    sizes = np.ones(terminals, np.int64)
    open_ = np.ones(len(sequence), bool)  # places whose pair may be frequent
    turn = 0
    while len(at := np.flatnonzero(open_[:-1])):
        turn += 1
        keys = sequence[at].astype(np.int64) << 32 | sequence[at + 1]
        # pairs that share a slot are counted together first: only full slots are sorted
        slot = _slots(keys, len(keys).bit_length() + 1, turn)
        full = np.bincount(slot)[slot] >= frequent
        at, keys = at[full], keys[full]
        found, times = np.unique(keys, return_counts=True)
        often = np.flatnonzero(times >= frequent)
        if not len(often):
            break
        pairs = _apart(found[often[np.argsort(-times[often], kind="stable")]], len(sizes))
        # pairs are looked up by a hash; of those that share a slot the rarer ones wait
        bits = max(8, len(pairs).bit_length() + 4)
        slots = np.full(1 << bits, -1, np.int32)
        slots[_slots(pairs[::-1], bits, turn)] = np.arange(len(pairs))[::-1]
        pairs = pairs[slots[_slots(pairs, bits, turn)] == np.arange(len(pairs))]
        slots[:] = -1
        slots[_slots(pairs, bits, turn)] = np.arange(len(pairs))
        open_[:] = False
        open_[at] = True
        place = slots[_slots(keys, bits, turn)]
        hit = (place >= 0) & (pairs[place] == keys)
        at, place = at[hit], place[hit]
        # in a run of one repeated symbol every other pair is taken
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        begin = np.repeat(at[run], np.diff(run, append=len(at)))
        even = (at - begin) % 2 == 0
        at, place = at[even], place[even]
        left.append(pairs >> 32)
        right.append(pairs & 0xFFFFFFFF)
        sequence[at] = len(sizes) + place
        sizes = np.concatenate([sizes, sizes[left[-1]] + sizes[right[-1]]])
        open_[at] = open_[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence, open_ = sequence[keep], open_[keep]
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return Block(terminals, join(left), join(right), sizes[terminals:], sequence, documents)


def _slots(keys: np.ndarray, bits: int, turn: int) -> np.ndarray:
    """Hashes of so many bits, others in every round."""
    return ((keys.view(U64) * U64(BASE + 2 * turn)) >> U64(64 - bits)).view(np.int64)


def _apart(pairs: np.ndarray, symbols: int) -> np.ndarray:
    """Those of the pairs, the most frequent first, of which no two can overlap: a symbol is only
    a left side or only a right side in a round, the side of the most frequent pair it occurs
    in; pairs that need it on the other side wait."""
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    rank = np.arange(len(pairs))
    side = np.full(symbols, 2 * len(pairs), np.int64)
    np.minimum.at(side, a, 2 * rank)
    np.minimum.at(side, b, 2 * rank + 1)
    twins = (a == b) & (side[a] == 2 * rank)
    return pairs[(side[a] % 2 == 0) & (side[b] % 2 == 1) & (a != b) | twins]


#: Byte values of two hashes; together they tell pieces apart.
EXACT = [mix(np.arange(k, k + 256, dtype=U64) * U64(BASE)) for k in (1, 1001)]


class Encoder:
    """Ids of whole texts. A byte-level pre-tokenizer always cuts before a single space
    between two other characters, so the pieces between such places are encoded on their
    own, each of them once: pieces are told apart by 128 bits of hash, cut, hashed, looked up
    and put together by array operations over many texts. Texts where white space meets
    white space, or with a very long piece, are encoded whole. If names of added tokens stand
    for these tokens (``named``), texts that hold one are encoded whole, too."""

    def __init__(self, path: str, named: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.whole = Tokenizer.from_file(path) if named else self.tokenizer
        self.names = [token.content for token in self.whole.get_added_tokens_decoder().values()] if named else []
        self.tokenizer.encode_special_tokens = True  # pieces and rows of them hold no names
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self.forget()

    def forget(self) -> None:
        # of each piece, in the order of its hash: the other hash, where its ids begin among
        # all ids, and how many it has (-1: it can only be encoded with what is around it)
        self.keys, self.checks = np.zeros(0, U64), np.zeros(0, U64)
        self.begins, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")
        self.tails: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        at = [i for i, text in enumerate(texts) if any(name in text for name in self.names)]
        held = set(at)
        out = self._encode([text if i not in held else "" for i, text in enumerate(texts)] if at else texts)
        for i, encoding in zip(at, self.whole.encode_batch_fast([texts[i] for i in at], add_special_tokens=False), strict=True):
            out[i] = array("I", encoding.ids).tobytes()
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        data, offsets = texts_of(pa.array(texts, pa.large_string()))
        spaces = np.flatnonzero(data == 0x20)
        cuts = np.searchsorted(spaces, offsets)
        starts = spaces + 1
        ends = np.append(spaces[1:], len(data))
        last = cuts[1:][np.diff(cuts) > 0] - 1
        ends[last] = offsets[1:][np.diff(cuts) > 0]
        sizes, ids = self._pieces(data, starts, ends)
        whole = np.zeros(len(texts), bool)
        whole[np.searchsorted(cuts, np.flatnonzero(sizes < 0), "right") - 1] = True
        places = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])[cuts] * 4
        stream = ids.tobytes()
        heads = [text.split(" ", 1)[0] for text in texts]
        whole |= [head[-1:].isspace() and len(head) < len(text) for head, text in zip(heads, texts, strict=True)]
        out = [head + stream[a:b] for head, a, b in zip(self._ids(heads), places, places[1:], strict=False)]
        again = np.flatnonzero(whole).tolist()
        for i, encoding in zip(again, self._ids([texts[i] for i in again]), strict=True):
            out[i] = encoding
        return out

    def _pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has (-1: none of its own) and the ids of all pieces."""
        if not len(starts):
            return np.zeros(0, np.int64), self.ids[:0]
        full = ends > starts
        key, check = np.zeros((2, len(starts)), U64)
        key[full], check[full] = (hashes(data, starts[full], ends[full], values) for values in EXACT)
        kinds, first, kind = np.unique(key, return_index=True, return_inverse=True)
        at, have = self._found(kinds, check[first])
        new = first[~have]
        if len(new):
            if len(self.keys) + len(new) > REMEMBERED:
                self._keep(np.unique(at[have]))
                self.tails = {}
            self._learn([data[a:b].tobytes() for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)], key[new], check[new])
            at, have = self._found(kinds, check[first])
        at = at[kind]
        sizes = self.sizes[at].astype(np.int64)
        sizes[check != self.checks[at]] = -1  # two pieces of one hash in these texts
        sizes[ends - starts > LONGEST] = -1
        run = np.maximum(sizes, 0)
        before = np.cumsum(run) - run
        return sizes, self.ids[np.repeat(self.begins[at] - before, run) + np.arange(run.sum())]

    def _found(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return at, (self.keys[at] == keys) & (self.checks[at] == checks) if len(self.keys) else np.zeros(len(keys), bool)

    def _keep(self, at: np.ndarray) -> None:
        """Forget all pieces but some."""
        run = np.maximum(self.sizes[at], 0).astype(np.int64)
        before = np.cumsum(run) - run
        self.ids = self.ids[np.repeat(self.begins[at] - before, run) + np.arange(run.sum())]
        self.keys, self.checks, self.sizes, self.begins = self.keys[at], self.checks[at], self.sizes[at], before

    def _learn(self, pieces: list[bytes], keys: np.ndarray, checks: np.ndarray) -> None:
        """Add pieces to those known. The pre-tokenizer also cuts between letters and the ASCII
        marks after them, so a word with marks has the ids of the word and of the marks."""
        texts = [piece.decode() if len(piece) <= LONGEST else "" for piece in pieces]
        marked, own = {}, {}
        for i, text in enumerate(texts):
            if text and not text[0].isspace() and not text[-1].isspace():
                stem = text.rstrip(string.punctuation)
                if stem != text and stem.isalpha():
                    marked[i] = stem
                else:
                    own[text] = i
        found = dict(zip(own, self._ids_after_spaces(list(own)), strict=True))
        stems = list(set(marked.values()) - found.keys())
        if stems:
            coded = [stem.encode() for stem in stems]
            ends = np.cumsum([len(c) for c in coded])
            starts = np.append(0, ends[:-1])
            key, check = (hashes(np.frombuffer(b"".join(coded), np.uint8), starts, ends, values) for values in EXACT)
            at, have = self._found(key, check)
            for k in np.flatnonzero(have).tolist():
                begin, size = self.begins[at[k]], self.sizes[at[k]]
                found[stems[k]] = self.ids[begin : begin + size].tobytes()
            new = np.flatnonzero(~have)
            fresh = [stems[k] for k in new.tolist()]
            found.update(zip(fresh, self._ids_after_spaces(fresh), strict=True))
            own |= {stem: len(texts) + k for k, stem in enumerate(fresh)}
            keys, checks = np.concatenate([keys, key[new]]), np.concatenate([checks, check[new]])
        tails = list({texts[i][len(stem) :] for i, stem in marked.items()} - self.tails.keys())
        self.tails.update(zip(tails, self._ids(tails), strict=True))
        parts = [b""] * len(keys)
        for text, i in own.items():
            parts[i] = found[text]
        for i, stem in marked.items():
            parts[i] = found[stem] + self.tails[texts[i][len(stem) :]]
        sizes = np.array([len(ids) // 4 or -1 for ids in parts], np.int32)
        run = np.maximum(sizes, 0).astype(np.int64)
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(run) - run])[order]
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(parts), "<u4")])
        self.keys, self.checks = np.concatenate([self.keys, keys])[order], np.concatenate([self.checks, checks])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]

    def _ids_after_spaces(self, words: list[str]) -> list[bytes]:
        """Ids of words that hold no space, each after one. They are encoded in long rows;
        a token that begins with a space begins a word, and no other does."""
        out: list[bytes] = []
        rows = ["".join(" " + word for word in words[at : at + 2000]) for at in range(0, len(words), 2000)]
        for encoding in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False):
            ids = np.array(encoding.ids, "<u4")
            data = ids.tobytes()
            cuts = (np.flatnonzero(self.opens[ids]) * 4).tolist()
            out += [data[a:b] for a, b in zip(cuts, [*cuts[1:], len(data)], strict=True)]
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]


@functools.cache
def encoder_of(path: str) -> Encoder:
    """One per worker: neither its vocabulary is read nor the pieces that it remembers are
    encoded anew by each task. Ids are those of the tokenizer on whole texts, so the name of
    an added token in a text is that token."""
    return Encoder(path, named=True)


BLOCKS = "shard int, block long, n long, first_doc long, last_doc long, doc_ids binary, data binary"


def encoded(docs: DataFrame, path: str, end: int = 0, terminals: int = 1 << 16, shards: int | None = None) -> DataFrame:
    """Blocks of all texts of ``docs``, one shard per range of ids. ``path`` names the
    tokenizer's file on every machine."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        tail = np.array([end], "<u4").tobytes()
        streams: list[bytes] = []
        owners: list[int | None] = []
        number = size = shard = 0

        def block() -> pa.RecordBatch:
            counts = np.array([len(s) // 4 for s in streams])
            data = compressed(np.frombuffer(b"".join(streams), "<u4"), counts, terminals)
            return pa.record_batch({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([number], pa.int64()),
                "n": pa.array([int(counts.sum())], pa.int64()),
                "first_doc": pa.array(owners[:1], pa.int64()), "last_doc": pa.array(owners[-1:], pa.int64()),
                "doc_ids": pa.array([pa.compress(_ids(owners), "zstd", asbytes=True)], pa.binary()),
                "data": pa.array([pa.compress(data.to_bytes(), "zstd", asbytes=True)], pa.binary()),
            })

        for batch in batches:
            for piece in pieces(batch):
                shard = piece["shard"][0].as_py()
                texts = [text or "" for text in piece["text"].to_pylist()]
                for doc_id, ids in zip(piece["doc_id"].to_pylist(), encoder.encode(texts), strict=True):
                    streams.append(ids + tail)
                    owners.append(doc_id)
                    size += len(streams[-1]) // 4
                    if size >= BLOCK:
                        yield block()
                        streams.clear()
                        owners.clear()
                        number, size = number + 1, 0
        if streams:
            yield block()

    ranged = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(shards, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .withColumn("shard", F.spark_partition_id())
    )
    return ranged.mapInArrow(run, BLOCKS)


def _ids(owners: list[int | None]) -> bytes:
    values = pa.array(owners, pa.int64())
    nulls = np.packbits(np.array([x is None for x in owners], bool)).tobytes()
    return values.fill_null(0).to_numpy().astype("<i8").tobytes() + nulls


def _owners(data: bytes, n: int) -> pa.Array:
    nulls = np.unpackbits(np.frombuffer(data, np.uint8, -1, 8 * n), count=n).astype(bool)
    return pa.array(np.frombuffer(data, "<i8", n), pa.int64(), mask=nulls)


def written(docs: DataFrame, path: str, folder: str | None = None, end: int = 0) -> str:
    """Write the blocks of all texts below ``folder`` (a fresh shared one) and return it."""
    folder = folder or new_path(docs.sparkSession, "token-blocks")
    encoded(docs, path, end).write.parquet(folder)
    return folder


def _places(blocks: DataFrame) -> DataFrame:
    """Ids before each block: sums of shards first, a row for each, then blocks within theirs."""
    totals = blocks.groupBy("shard").agg(F.sum("n").alias("all"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("shard", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inside"))
    return starts.join(totals, "shard").select("shard", "block", (F.col("base") + F.col("inside")).alias("start"))


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from its block: doc_id, start (ids of all documents before it),
    n_tokens and the ids as little-endian 32-bit numbers."""
    blocks = spark.read.schema(BLOCKS).parquet(folder)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block, owners = opened(row)
                ids = block.expand(block.sequence)
                cuts = np.concatenate([[0], np.cumsum(block.documents.astype(np.int64))])
                for a in range(0, len(owners), 256):
                    part = range(a, min(a + 256, len(owners)))
                    yield pa.record_batch({
                        "doc_id": owners[part.start : part.stop],
                        "start": pa.array([row["start"] + int(cuts[i]) for i in part], pa.int64()),
                        "n_tokens": pa.array([int(block.documents[i]) for i in part], pa.int64()),
                        "ids": pa.array([ids[cuts[i] : cuts[i + 1]].tobytes() for i in part], pa.binary()),
                    })

    placed = blocks.join(_places(blocks.select("shard", "block", "n")), ["shard", "block"])
    return placed.select("start", "doc_ids", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def opened(row: dict) -> tuple[Block, pa.Array]:
    """The block in a row of the written table, and whose documents it holds."""
    reader = pa.CompressedInputStream(pa.BufferReader(row["data"]), "zstd")
    block = Block.from_bytes(reader.read())
    owners = pa.CompressedInputStream(pa.BufferReader(row["doc_ids"]), "zstd").read()
    return block, _owners(owners, len(block.documents))


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids, of all documents in the blocks."""
    return read_back(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
