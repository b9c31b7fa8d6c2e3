"""Language-model scoring: an interpolated modified Kneser-Ney bigram model.

Training counts on Spark in three passes of mergeable blocks: word types, bigrams, and
what is known of each type as a context and as a continuation. A block is a sorted array
of hashes or ids with its counts, summed up in the task before it is shuffled, so a
frequent word or pair is one entry per task. The merged blocks are written to the shared
folder as sorted hash arrays; scoring tasks map them into memory and look up by binary
search, so neither the driver nor a worker ever holds the model.

Every text ends in an end token, which is a word type of its own, and starts in a
begin context, which is not. Null text counts as empty: one token, the end.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.files import mapped, save
from millrace.llm.words import U64, mix, pieces, powers, sum_by, texts_of, words_of
from millrace.session import materialise, new_path

#: Hash of the end token. A word cannot be empty, so no text spells it.
END = U64(0x5851F42D4C957F2D)
#: Tokens gathered by a task before it sums them up, and so the memory it takes.
GATHERED = 1 << 21
#: Added to each count of the base model.
ADDED = 0.1
SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def pack(values: np.ndarray) -> bytes:
    """Sorted whole numbers as compressed differences, their bytes by significance."""
    steps = np.diff(values.astype(U64), prepend=U64(0))
    return pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T), "zstd", asbytes=True)


def unpack(block: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(block, n * 8, "zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view(U64).ravel(), dtype=U64)


def pack_any(values: np.ndarray) -> bytes:
    plain = np.ascontiguousarray(values.astype(U64).view(np.uint8).reshape(-1, 8).T)
    return pa.compress(plain, "zstd", asbytes=True)


def unpack_any(block: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(block, n * 8, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(U64).ravel()


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of each array of values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)


BLOCKS = "bucket int, n long, keys binary, counts binary"


def blocks(keys: np.ndarray, counts: np.ndarray, buckets: np.ndarray) -> pa.RecordBatch:
    """One row per bucket with the sorted keys and counts that fall into it."""
    order = np.argsort(buckets, kind="stable")
    keys, counts, buckets = keys[order], counts[order], buckets[order]
    cuts = np.flatnonzero(np.diff(buckets, prepend=-1)) if len(keys) else np.zeros(0, np.int64)
    parts = list(zip(cuts, [*cuts[1:], len(keys)], strict=True))
    return pa.record_batch({
        "bucket": pa.array([int(buckets[a]) for a, _ in parts], pa.int32()),
        "n": pa.array([b - a for a, b in parts], pa.int64()),
        "keys": pa.array([pack(keys[a:b]) for a, b in parts], pa.binary()),
        "counts": pa.array([pack_any(counts[a:b]) for a, b in parts], pa.binary()),
    })


def top_bits(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def stream_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each followed by an end, and the offsets."""
    words = words_of(texts_of(batch["text"]))
    n = len(words.docs) - 1
    offsets = words.docs + np.arange(n + 1)
    tokens = np.full(offsets[-1], END, U64)
    at = np.ones(len(tokens), bool)
    at[offsets[1:] - 1] = False
    tokens[at] = words.hashes
    return tokens, offsets


@dataclass
class SortedFiles:
    """Sorted arrays in files of consecutive ranges, with columns beside them."""

    path: str
    lengths: list[int]
    bits: int

    def __post_init__(self) -> None:
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.open: dict[tuple[int, str], np.ndarray] = {}

    def column(self, bucket: int, name: str, dtype: str) -> np.ndarray:
        if (bucket, name) not in self.open:
            self.open[bucket, name] = mapped(f"{self.path}/{name}-{bucket}", dtype, self.lengths[bucket])
        return self.open[bucket, name]

    def find(self, keys: np.ndarray, hashed: np.ndarray | None = None) -> np.ndarray:
        """Place of each key in all files taken together, -1 where it is not there.
        Keys of one bucket should come in order, for the sake of the memory pages."""
        out = np.full(len(keys), -1, np.int64)
        buckets = top_bits(keys if hashed is None else hashed, self.bits)
        order = np.argsort(buckets, kind="stable")
        cuts = np.searchsorted(buckets[order], np.arange(len(self.lengths) + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            if not self.lengths[b]:
                continue
            at, there = order[cuts[b] : cuts[b + 1]], self.column(b, "keys", "uint64")
            place = np.minimum(np.searchsorted(there, keys[at]), len(there) - 1)
            out[at] = np.where(there[place] == keys[at], place + self.offsets[b], -1)
        return out

    def take(self, name: str, dtype: str, places: np.ndarray) -> np.ndarray:
        """Values of a column at places found before."""
        out = np.zeros(len(places), dtype)
        buckets = np.searchsorted(self.offsets, places, "right") - 1
        order = np.argsort(buckets, kind="stable")
        cuts = np.searchsorted(buckets[order], np.arange(len(self.lengths) + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[b] : cuts[b + 1]]
            out[at] = self.column(b, name, dtype)[places[at] - self.offsets[b]]
        return out

    def __getstate__(self) -> dict:
        return {"path": self.path, "lengths": self.lengths, "bits": self.bits}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)


@dataclass
class Model:
    """Where the counts are, and the few numbers that the formulas need besides."""

    types: SortedFiles  # by word hash: keys, counts; by id: contexts, backoffs, continuations
    pairs: SortedFiles  # by bigram: keys, counts
    begin: tuple[float, float]  # total and backoff weight of the begin context
    n_tokens: int
    n_types: int
    bigram_discounts: list[float]
    type_discounts: list[float]
    continuations: int
    type_backoff: float
    wide: set[int]  # buckets of bigrams with a count beyond 32 bits


def discounts_of(n: list[int]) -> list[float]:
    """Discounts for counts of 1, 2 and 3 or more, by the usual closed form from how many
    entries have counts 1 to 4; where one of these is missing, half of each whole step."""
    if min(n[:4]) <= 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return [min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), found, strict=True)]


def discount(counts: np.ndarray, values: list[float]) -> np.ndarray:
    return np.array([0.0, *values])[np.minimum(counts, 3).astype(np.int64)]


def _gathered(batches: Iterator[pa.RecordBatch], keys_of: Callable, bucket_of: Callable) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    size = 0

    def given() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return blocks(keys, counts, bucket_of(keys))

    for batch in batches:
        for piece in pieces(batch):
            held.append(keys_of(piece))
            size += len(held[-1])
            if size >= GATHERED:
                yield given()
                held, size = [], 0
    if held:
        yield given()


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    sizes = table["n"].to_pylist()
    keys = [unpack(k.as_py(), n) for k, n in zip(table["keys"], sizes, strict=True)]
    counts = [unpack_any(c.as_py(), n) for c, n in zip(table["counts"], sizes, strict=True)]
    return summed(np.concatenate(keys), np.concatenate(counts))


def _counted(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def _bits(spark: SparkSession) -> int:
    """Buckets follow the number of shuffle partitions, which is sized by the input."""
    return max(4, math.ceil(math.log2(int(spark.conf.get("spark.sql.shuffle.partitions")))))


def train(docs: DataFrame) -> Model:
    """Count ``docs.text`` and write the model's arrays to the shared folder. An empty
    table gives a model without types, by which any token has probability 1."""
    spark, texts = docs.sparkSession, docs.select("text")
    path, bits = new_path(spark, "kneser-ney"), _bits(docs.sparkSession)

    def count_words(batches):
        return _gathered(batches, lambda b: stream_of(b)[0], lambda keys: top_bits(keys, bits))

    def keep_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = _merged(table)
        save(f"{path}/types/keys-{key[0].as_py()}", keys)
        save(f"{path}/types/counts-{key[0].as_py()}", counts)
        return pa.table({"bucket": [key[0].as_py()], "n": [len(keys)], "tokens": [int(counts.sum())]})

    stats = (
        texts.mapInArrow(count_words, BLOCKS).groupBy("bucket").applyInArrow(keep_words, "bucket long, n long, tokens long")
    ).collect()  # a row per bucket
    lengths = [0] * (1 << bits)
    for row in stats:
        lengths[row.bucket] = row.n
    types = SortedFiles(f"{path}/types", lengths, bits)
    n_types, n_tokens = sum(lengths), sum(row.tokens for row in stats)
    if n_types >= 1 << 32:
        raise ValueError("a pair of word ids is packed into 64 bits: at most 2^32 - 1 word types")

    def count_pairs(batches):
        yield from _gathered(batches, lambda b: _pairs(types, n_types, b)[0], lambda keys: top_bits(mix(keys), bits))

    def keep_pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = _merged(table)
        save(f"{path}/pairs/keys-{key[0].as_py()}", keys)
        save(f"{path}/pairs/counts-{key[0].as_py()}", counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts)
        wide = int(counts.max(initial=0) >= 1 << 32)
        few = [(counts == k).astype(U64) for k in (1, 2)]
        before, *sums = summed(keys >> U64(32), counts, *few, np.ones(len(keys), U64))
        after, heads = summed(keys & U64(0xFFFFFFFF), np.ones(len(keys), U64))
        rows = [{"kind": 2, "bucket": key[0].as_py(), "n": len(keys), "wide": wide, "few": _counted(counts)}]
        for kind, ids, columns in ((0, before, sums), (1, after, [heads])):
            owner = np.minimum(np.searchsorted(types.offsets, ids.astype(np.int64), "right") - 1, (1 << bits) - 1)
            cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1), len(ids)]
            rows += [
                {"kind": kind, "bucket": int(owner[a]), "n": int(b - a), "keys": pack(ids[a:b]), "columns": [pack_any(c[a:b]) for c in columns]}
                for a, b in zip(cuts, cuts[1:], strict=False) if b > a
            ]
        return pa.Table.from_pylist(rows, pa.schema([
            ("kind", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("wide", pa.int32()),
            ("few", pa.list_(pa.int64())), ("keys", pa.binary()), ("columns", pa.list_(pa.binary())),
        ]))

    parts = materialise(
        texts.mapInArrow(count_pairs, BLOCKS).groupBy("bucket").applyInArrow(
            keep_pairs,
            "kind int, bucket int, n long, wide int, few array<long>, keys binary, columns array<binary>",
        ),
        "bigram-parts",
    )
    stats = parts.where("kind = 2").select("bucket", "n", "wide", "few").collect()  # a row per bucket
    lengths, wide = [0] * (1 << bits), {row.bucket for row in stats if row.wide}
    for row in stats:
        lengths[row.bucket] = row.n
    pairs = SortedFiles(f"{path}/pairs", lengths, bits)
    bigram_discounts = discounts_of([sum(row.few[k] for row in stats) for k in range(4)])

    def keep_contexts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        low, size = int(types.offsets[bucket]), types.lengths[bucket]
        size += bucket == (1 << bits) - 1  # the begin context follows the last type
        total, ones, twos, all_ = (np.zeros(size, np.int64) for _ in range(4))
        heads = np.zeros(size, np.int64)
        for row in table.to_pylist():
            at = unpack(row["keys"], row["n"]).astype(np.int64) - low
            columns = [unpack_any(c, row["n"]).astype(np.int64) for c in row["columns"]]
            for have, more in zip((total, ones, twos, all_) if row["kind"] == 0 else (heads,), columns, strict=True):
                have[at] += more
        d1, d2, d3 = bigram_discounts
        taken = d1 * ones + d2 * twos + d3 * (all_ - ones - twos)
        backoff = np.where(total > 0, taken / np.maximum(total, 1), 1.0)
        n = types.lengths[bucket]
        save(f"{path}/types/contexts-{bucket}", total[:n])
        save(f"{path}/types/backoffs-{bucket}", backoff[:n])
        save(f"{path}/types/continuations-{bucket}", heads[:n])
        begin = [float(total[n]), float(backoff[n])] if size > n else None
        return pa.Table.from_pylist(
            [{"begin": begin, "few": _counted(heads[heads > 0]), "many": int((heads > 2).sum()), "heads": int(heads.sum())}],
            pa.schema([("begin", pa.list_(pa.float64())), ("few", pa.list_(pa.int64())), ("many", pa.int64()), ("heads", pa.int64())]),
        )

    stats = (
        parts.where("kind < 2").groupBy("bucket")
        .applyInArrow(keep_contexts, "begin array<double>, few array<long>, many long, heads long")
    ).collect()  # a row per bucket
    few = [sum(row.few[k] for row in stats) for k in range(4)]
    heads, many = sum(row.heads for row in stats), sum(row.many for row in stats)
    type_discounts = discounts_of(few)
    left = sum(d * n for d, n in zip(type_discounts, [few[0], few[1], many], strict=True))
    begin = next((tuple(row.begin) for row in stats if row.begin), (0.0, 1.0))
    return Model(
        types, pairs, begin, n_tokens, n_types, bigram_discounts, type_discounts, heads, left / heads if heads else 1.0, wide
    )


def _pairs(types: SortedFiles, n_types: int, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Packed bigrams of the texts; with them token ids, contexts' ids and offsets."""
    tokens, offsets = stream_of(batch)
    distinct, at = np.unique(tokens, return_inverse=True)
    ids = types.find(distinct)[at]
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[offsets[:-1]] = n_types  # the begin context
    return (before.astype(U64) << U64(32)) | (ids.astype(U64) & U64(0xFFFFFFFF)), ids, before, offsets


def scored(model: Model, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Scores of each text of a batch."""
    keys, ids, before, offsets = _pairs(model.types, model.n_types, batch)
    place, at = np.unique(ids, return_inverse=True)
    known = place >= 0
    counts, heads = np.zeros(len(place)), np.zeros(len(place), np.int64)
    counts[known] = model.types.take("counts", "uint64", place[known])
    heads[known] = model.types.take("continuations", "int64", place[known])
    lower = np.full(len(place), model.type_backoff / (model.n_types + 1))
    if model.continuations:
        lower += np.maximum(heads - discount(heads, model.type_discounts), 0) / model.continuations
    base = np.log10((counts + ADDED) / (model.n_tokens + ADDED * (model.n_types + 1)))

    context, back = np.unique(before, return_inverse=True)
    inside = (context >= 0) & (context < model.n_types)
    total, backoff = np.zeros(len(context)), np.ones(len(context))
    total[inside] = model.types.take("contexts", "int64", context[inside])
    backoff[inside] = model.types.take("backoffs", "float64", context[inside])
    begin = context == model.n_types
    total[begin], backoff[begin] = model.begin

    seen = (ids >= 0) & (before >= 0)
    pair, pair_at = np.unique(keys[seen], return_inverse=True)
    places = model.pairs.find(pair, mix(pair))
    times = np.zeros(len(pair), np.int64)
    found = np.flatnonzero(places >= 0)
    wide = np.isin(top_bits(mix(pair[found]), model.pairs.bits), [*model.wide])
    for kind, mine in (("uint32", found[~wide]), ("uint64", found[wide])):
        times[mine] = model.pairs.take("counts", kind, places[mine])
    left = np.maximum(times - discount(times, model.bigram_discounts), 0)
    p = lower[at] * backoff[back]
    p[seen] += left[pair_at] / np.maximum(total[back[seen]], 1)
    return {
        "n_tokens": np.diff(offsets),
        "n_known": sum_by((ids >= 0).astype(np.int64), offsets),
        "base_score": sum_by(base[at], offsets),
        "score": sum_by(np.log10(p), offsets),
    }


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens (the end included), n_known (tokens seen in
    training), base_score (add-0.1 unigrams) and score, both log10 of the whole text's
    probability."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                yield pa.record_batch({"doc_id": piece["doc_id"], **scored(model, piece)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCORES)


def held_out_scores(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Train on the documents whose crc32(doc_id) mod ``folds`` is not 0 and score all."""
    model = train(docs.where(remainder(folds) != 0))
    scores = score(docs, model)
    return scores.select(
        "doc_id", (remainder(folds) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
