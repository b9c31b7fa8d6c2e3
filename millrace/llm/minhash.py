"""Near-duplicates by b-bit MinHash, confirmed on full shingle sets.

Texts with the same shingles form a class, and one of each class goes on. Minima of many
hash functions, cut into bands, give the candidates: classes that agree in a whole band.
Of each minimum only the low bits are kept, packed into a few words; from the number of
equal ones the similarity is estimated, corrected for the chance that different minima
agree in their low bits, and candidates far below the threshold are dropped. The others
are compared by their full sets.

Groups of any size are linked without listing their pairs: first each member of a bucket
is compared with the bucket's smallest id only. Then just those buckets whose members
are still in different components are looked at again: members that have too many
shingles which no other component has cannot be linked with one and go, and pairs of the
others across components are compared. So no link between different components is lost;
what is given is each document's component, not all pairs.

A null text, or one without words, has no shingles and is linked with nothing, and so is
a row without an id. A text of fewer words than a shingle has its whole sequence as one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.words import BASE, U64, mix, pieces, texts_of, windows, words_of
from millrace.session import materialise, working

#: Minima of every text, and further ones of candidates, for a sharper estimate.
MINIMA = 192
DEEP = 1024
KEPT_BITS = 4
PER_LONG = 64 // KEPT_BITS
LOW = 0x1111111111111111
#: Standard deviations of the estimate by which a candidate may miss the threshold.
SLACK = 4.5
#: Chance of a pair at the threshold to agree in no band.
MISSED = 1e-6
#: Rounds in which members of a bucket are compared with one of them only.
STARS = 2
#: Members of a bucket that are compared with each other in one go.
BLOCK = 4096


@dataclass(frozen=True)
class Likeness:
    """Shingle length in words and the threshold in per cent of intersection to union."""

    shingle: int = 5
    percent: int = 80

    @property
    def threshold(self) -> float:
        return self.percent / 100

    @property
    def rows(self) -> int:
        """Minima per band: as many as keep the chance of a missed pair small enough."""
        fit = [r for r in range(1, 17) if (1 - self.threshold**r) ** (MINIMA // r) <= MISSED]
        return max(fit, default=1)

    def least_equal(self, kept: int = MINIMA) -> int:
        """Equal parts, of those kept, from which a candidate is compared further."""
        chance = self.threshold + (1 - self.threshold) / (1 << KEPT_BITS)
        return int(kept * (chance - SLACK * np.sqrt(chance * (1 - chance) / kept)))

    def linked(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


_RANDOM = mix(np.arange(1, 2 * (MINIMA + DEEP) + 1, dtype=U64) * U64(BASE))
FACTORS = (_RANDOM[::2] >> U64(32)).astype(np.uint32) | np.uint32(1)
ADDENDS = (_RANDOM[1::2] >> U64(32)).astype(np.uint32)


def shingle_sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = words_of(texts_of(batch["text"]))
    rolled, offsets = windows(words.hashes, words.docs, size)
    out = []
    for i in range(batch.num_rows):
        a, b = words.docs[i], words.docs[i + 1]
        if b - a >= size:
            out.append(np.unique(rolled[offsets[i] : offsets[i + 1]]))
            continue
        whole = np.zeros(1, U64)
        for h in words.hashes[a:b]:
            whole = mix(whole * U64(BASE) + h + U64(1))
        out.append(whole[: int(b > a)])
    return out


def minima(shingles: np.ndarray, functions: slice = slice(0, MINIMA)) -> np.ndarray:
    """The smallest value of some hash functions over a set."""
    short, factors, addends = (shingles >> U64(32)).astype(np.uint32), FACTORS[functions], ADDENDS[functions]
    out = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(out, (short[at : at + 2048, None] * factors + addends).min(0), out=out)
    return out


def packed(smallest: np.ndarray) -> np.ndarray:
    """Low bits of scrambled minima, ``PER_LONG`` of them to a word; rows of minima."""
    low = mix(smallest.astype(U64)) & U64((1 << KEPT_BITS) - 1)
    low = low.reshape(len(smallest), -1, PER_LONG)
    return np.bitwise_or.reduce(low << (np.arange(PER_LONG, dtype=U64) * U64(KEPT_BITS)), axis=2)


def band_keys(smallest: np.ndarray, rows: int) -> np.ndarray:
    bands = MINIMA // rows
    cut = smallest[:, : bands * rows].reshape(len(smallest), bands, rows).astype(U64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=U64), cut.shape[:2]).copy()
    for k in range(rows):
        keys = mix(keys * U64(BASE) + cut[:, :, k])
    return keys


def equal_parts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many kept parts agree, for rows of packed words, by bit counts."""
    differ = a ^ b
    spread = differ.copy()
    for k in range(1, KEPT_BITS):
        spread |= differ >> U64(k)
    return a.shape[-1] * PER_LONG - np.bitwise_count(spread & U64(LOW)).sum(-1, dtype=np.int64)


def equal_parts_of(a: str, b: str) -> Column:
    """The same, over two array columns."""

    def different(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        spread = z
        for k in range(1, KEPT_BITS):
            spread = spread.bitwiseOR(F.shiftrightunsigned(z, k))
        return F.bit_count(spread.bitwiseAND(F.lit(LOW)))

    parts = (different(F.col(a)[k], F.col(b)[k]) for k in range(MINIMA // PER_LONG))
    return F.lit(MINIMA) - sum(parts, F.lit(0))


def estimated(equal: np.ndarray, kept: int = MINIMA) -> np.ndarray:
    """Similarity by the share of equal parts, less those that agree by chance."""
    chance = 1 / (1 << KEPT_BITS)
    return (equal / kept - chance) / (1 - chance)


def longs(rows: np.ndarray) -> pa.Array:
    """Rows of 64-bit words as an array column."""
    flat = pa.array(np.ascontiguousarray(rows).view(np.int64).ravel())
    return pa.FixedSizeListArray.from_arrays(flat, rows.shape[1]).cast(pa.list_(pa.int64()))


def words_in(column: pa.ChunkedArray) -> np.ndarray:
    """Such a column as rows of words."""
    flat = column.combine_chunks().flatten().to_numpy()
    return flat.view(U64).reshape(len(column), -1)


def signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, a 128-bit name of the set (null if empty),
    band keys and packed low bits."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                sets = shingle_sets(piece, like.shingle)
                smallest = np.stack([minima(s) for s in sets])
                full = np.array([len(s) > 0 for s in sets])
                yield pa.record_batch({
                    "doc_id": piece["doc_id"], "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "name": pa.array(
                        [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if n else None for s, n in zip(sets, full, strict=True)],
                        pa.binary(),
                    ),
                    "bands": longs(band_keys(smallest, like.rows)), "low": longs(packed(smallest)),
                })

    schema = "doc_id long, n_shingles long, name binary, bands array<long>, low array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def full_sets(docs: DataFrame, ids: DataFrame, like: Likeness) -> DataFrame:
    """``id``, the whole shingle set and the low bits of further minima of the documents
    named by ``ids``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")

    def cut(batches):
        for batch in batches:
            for piece in pieces(batch):
                sets = shingle_sets(piece, like.shingle)
                further = np.stack([minima(s, slice(MINIMA, None)) for s in sets])
                yield pa.record_batch({
                    "id": piece["doc_id"], "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
                    "deep": longs(packed(further)),
                })

    return texts.mapInArrow(cut, "id long, shingles binary, deep array<long>")


def confirmed(sets: DataFrame, pairs: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are alike enough. Of a pair, only one
    side's set moves to the other's."""
    right = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("right")), "b")
    both = right.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("left")), "a")

    def compare(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            last, left = None, None
            for i in range(batch.num_rows):
                view = batch["left"][i].as_buffer()
                if last is None or not view.equals(last):
                    last, left = view, np.frombuffer(view, U64)
                right = np.frombuffer(batch["right"][i].as_buffer(), U64)
                place = np.minimum(np.searchsorted(left, right), max(len(left) - 1, 0))
                common = int((left[place] == right).sum()) if len(left) else 0
                keep[i] = like.linked(common, len(left), len(right)) and len(right) > 0
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "left", "right").mapInArrow(compare, "a long, b long")


def common_at_most(labelled: DataFrame, sets: DataFrame) -> DataFrame:
    """``id`` and ``most``: how many of its shingles any other component of the labelled
    ids has as well."""
    own = labelled.select("id", "component").distinct()

    def spread(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = np.frombuffer(batch["shingles"][i].as_buffer(), np.int64)
                same = lambda name: pa.array(np.full(len(found), batch[name][i].as_py(), np.int64))  # noqa: E731, B023
                yield pa.record_batch({"id": same("id"), "component": same("component"), "shingle": found})

    rows = sets.join(own, "id").select("id", "component", "shingles").mapInArrow(spread, "id long, component long, shingle long")
    rows = materialise(rows, "open-shingles")
    owners = rows.groupBy("shingle").agg(F.min("component").alias("first"), F.max("component").alias("last"))
    several = owners.where("first <> last").select("shingle")
    return rows.join(several, "shingle").groupBy("id").agg(F.count(F.lit(1)).alias("most"))


def across(rows: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of a bucket's members in different components that may be alike. ``rows``: key,
    id, n_shingles, bands, deep, component, most (shingles in common with other components).
    A pair is given by the first of the buckets that it shares.

    Members meet only if their sizes can be: in size classes a threshold's factor wide, a
    pair's members are in one class or in neighbours. Large classes are cut into blocks,
    and each pair of blocks is a group of its own."""
    # a link has percent / (100 + percent) of both sizes in common, the smaller one at least
    # percent of the larger
    smallest = F.col("n_shingles") + F.ceil(F.col("n_shingles") * like.percent / 100)
    rows = rows.where(F.col("most") * (100 + like.percent) >= smallest * like.percent)
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / -float(np.log(like.threshold)))
    spread = rows.withColumn("p", F.explode(F.array(
        F.struct(size.alias("at"), F.lit(0).alias("upper")), F.struct((size - 1).alias("at"), F.lit(1).alias("upper"))
    ))).select("*", "p.at", "p.upper").drop("p")
    several = spread.groupBy("key", "at").agg(
        F.count(F.lit(1)).alias("members"), F.min("upper").alias("lower"), F.min("component").alias("first"),
        F.max("component").alias("last"),
    ).where("members > 1 and lower = 0 and first <> last").select("key", "at", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    cut = spread.join(several, ["key", "at"]).withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}
    ).drop("blocks", "other")

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket, i, j = U64(key[0].as_py() & 0xFFFFFFFFFFFFFFFF), key[2].as_py(), key[3].as_py()
        ids, sizes, part, upper, label, most = (
            table[name].to_numpy() for name in ("id", "n_shingles", "mine", "upper", "component", "most")
        )
        deep, bands = words_in(table["deep"]), words_in(table["bands"])
        first, quick = deep[:, : MINIMA // PER_LONG].copy(), like.least_equal()
        found = [np.zeros((2, 0), np.int64)]
        for at in range(0, len(ids), 16):
            one = np.arange(at, min(at + 16, len(ids)))
            fits = (
                (label[one, None] != label) & (upper[one, None] + upper < 2)
                & (100 * np.minimum(sizes[one, None], sizes) >= like.percent * np.maximum(sizes[one, None], sizes))
                & (np.minimum(most[one, None], most) * (100 + like.percent) >= like.percent * (sizes[one, None] + sizes))
                & (ids[one, None] < ids) & ((part[one, None] != part) | (i == j))
            )
            x, y = np.nonzero(fits)
            x = one[x]
            near = equal_parts(first[x], first[y]) >= quick
            x, y = x[near], y[near]
            for low in range(0, len(x), 8192):
                p, q = x[low : low + 8192], y[low : low + 8192]
                same = bands[p] == bands[q]
                here = bands[p, same.argmax(1)] == bucket
                p, q = p[here], q[here]
                near = equal_parts(deep[p], deep[q]) >= like.least_equal(DEEP)
                found.append(np.stack([ids[p[near]], ids[q[near]]]))
        a, b = np.concatenate(found, 1)
        return pa.table({"a": a, "b": b})

    return cut.groupBy("key", "at", "i", "j").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept (the document is its
    component's smallest id; so is one without shingles). A null doc_id is kept."""
    signed = materialise(signatures(docs, like), "signatures")
    classes = materialise(
        signed.where("name is not null and doc_id is not null").groupBy("name").agg(F.min("doc_id").alias("id")), "classes"
    )
    heads = materialise(
        signed.withColumnRenamed("doc_id", "id").join(classes, ["name", "id"], "left_semi").dropDuplicates(["name"])
        .select("id", "n_shingles", "bands", "low"),
        "class-heads",
    )
    low = heads.select("id", "n_shingles", "low")
    entries = heads.select("id", F.explode("bands").alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    members = materialise(entries.join(shared, "key"), "bucket-members")
    sets = materialise(full_sets(docs, members.select("id").distinct(), like), "shingle-sets")

    def near(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that may be alike by their sizes and kept bits."""
        left = low.select(F.col("id").alias("a"), F.col("n_shingles").alias("size_a"), F.col("low").alias("low_a"))
        right = low.select(F.col("id").alias("b"), F.col("n_shingles").alias("size_b"), F.col("low").alias("low_b"))
        return pairs.join(left, "a").join(right, "b").where(
            (F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * like.percent)
            & (equal_parts_of("low_a", "low_b") >= like.least_equal())
        ).select("a", "b")

    # stars: each member of a bucket against one of them, at first the smallest
    labelled, found = members.withColumn("component", F.col("id")), None
    tested: DataFrame | None = None
    for turn in range(STARS):
        rank = F.struct(F.xxhash64(F.col("id") * turn, F.lit(turn)) if turn else F.lit(0), "id", "component")
        centers = labelled.groupBy("key").agg(F.min(rank).alias("c")).select("key", F.col("c.id").alias("center"), F.col("c.component").alias("other"))
        pairs = labelled.join(centers, "key").where("component <> other").select(
            F.least("center", "id").alias("a"), F.greatest("center", "id").alias("b")
        ).distinct()
        fresh = near(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        fresh = materialise(fresh, "near-stars")
        links = materialise(confirmed(sets, fresh, like), "star-links")
        tested = fresh if tested is None else materialise(tested.union(fresh), "tested")
        found = components(links if found is None else _stars(found).union(links))
        labelled = materialise(_open(members, found), "open-buckets")
    rows = labelled.join(common_at_most(labelled, sets), "id").join(heads.select("id", "n_shingles", "bands"), "id").join(
        sets.select("id", "deep").dropDuplicates(["id"]), "id"
    )
    rest = across(rows, like).join(tested, ["a", "b"], "left_anti")
    more = materialise(confirmed(sets, materialise(rest, "near-pairs"), like), "pair-links")
    found = components(_stars(found).union(more))

    named = signed.select("doc_id", "n_shingles", "name").join(classes, "name", "left")
    component = F.coalesce("component", "id", "doc_id")
    return named.join(found, "id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _stars(found: DataFrame) -> DataFrame:
    return found.select(F.col("component").alias("a"), F.col("id").alias("b"))


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with their components, of the buckets that have more than one of these."""
    known = found.withColumnRenamed("component", "known")
    labelled = members.join(known, "id", "left").select("key", "id", F.coalesce("known", "id").alias("component"))
    split = labelled.groupBy("key").agg(F.min("component").alias("first"), F.max("component").alias("last"))
    return labelled.join(split.where("first <> last").select("key"), "key", "left_semi")


def deduplicated(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs``, with all their columns, one of each component: the one with the
    smallest id, of several such rows any. Rows without shingles or id all stay.

    Rows are told apart by a number of their own, so one id may have several texts, and
    travel as one column, so theirs may have any names."""
    with working(docs.sparkSession):
        rows = materialise(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.monotonically_increasing_id().alias("number")), "rows", codec="zstd")
        known = F.col("row.doc_id").isNotNull()
        found = near_duplicates(
            rows.where(known).select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), like
        ).select(F.col("doc_id").alias("number"), F.col("component_id").alias("component"))
        ids = rows.select("number", F.col("row.doc_id").cast("long").alias("id"))
        first = found.join(ids, "number").groupBy("component").agg(F.min(F.struct("id", "number")).alias("first"))
        kept = rows.where(known).join(first.select("first.number"), "number", "left_semi")
        return materialise(kept.unionByName(rows.where(~known)).select("row.*"), "deduplicated", keep=True, codec="zstd")
