"""Merkle manifest of a table: a root over all rows, and for each row a witness of it.

Each row's leaf is the hash of its columns. Per language the leaves, in ascending order of
their ids, are the leaves of a tree in which every two consecutive nodes become one, the
last possibly alone; the languages' roots, in order, are the leaves of the tree above.

Leaves are appended in order, in aligned blocks. An append attaches an empty witness to a
subtree of one leaf; two subtrees of a height that meet become one, and every witness in
either is extended by the root of the other. A block's root is an append of its own in the
tree of block roots, which is cut into blocks again; what a block's root gets as witness
there extends those of all its leaves. No task holds more than a block.

A witness is a row of 33 bytes a level: where the sibling stands (``L``, ``R``, or ``N`` for
none) and its digest. Digests are kept as 32 bytes and hashed as hex text.

A null value is hashed as ``-``. Rows without an id come first in their language; rows of
one id are in the order of their leaves, and repeated rows are leaves each. Texts are
hashed whole, by Spark. Null is a language of its own. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialise, working

#: Leaves of a block: two to this power.
BITS = 10
#: What a leaf is the hash of, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = 33


def joined_hash(*digests: bytes) -> bytes:
    """The hash of digests, as hex text, one after the other."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


class Frontier:
    """The open subtrees of a run of leaves, and the witnesses of all leaves so far."""

    def __init__(self) -> None:
        self.open: list[tuple[int, bytes, int]] = []  # height, root, first leaf
        self.witnesses: list[bytearray] = []

    def append(self, leaf: bytes) -> None:
        self.open.append((0, leaf, len(self.witnesses)))
        self.witnesses.append(bytearray())
        self._meet()

    def _meet(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            (height, left, first), (_, right, middle) = self.open[-2:]
            for witness in self.witnesses[first:middle]:
                witness += b"R" + right
            for witness in self.witnesses[middle:]:
                witness += b"L" + left
            self.open[-2:] = [(height + 1, joined_hash(left, right), first)]

    def close(self, height: int | None = None) -> bytes:
        """The root, of the given height or of the least that all leaves need: a subtree
        without a sibling rises alone."""
        while len(self.open) > 1 or (height is not None and self.open[-1][0] < height):
            at, root, first = self.open[-1]
            for witness in self.witnesses[first:]:
                witness += b"N" + bytes(32)
            self.open[-1] = (at + 1, joined_hash(root), first)
            self._meet()
        return self.open[0][1]


def siblings(witness: bytes) -> list[tuple[bytes, bytes]]:
    """Side and digest, level by level."""
    return [(witness[at : at + 1], witness[at + 1 : at + STEP]) for at in range(0, len(witness), STEP)]


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    node = leaf
    for side, digest in siblings(witness):
        node = joined_hash(node) if side == b"N" else joined_hash(digest, node) if side == b"L" else joined_hash(node, digest)
    return node


def leaf_of(**other: Column) -> Column:
    """The leaf of a row; ``other`` are expressions in place of columns."""
    parts = []
    for name in COLUMNS:
        value = other.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place of a row within its ``tree``, trees first and then ``order``,
    and ``n``, the tree's rows. Rows are dealt out by ranges of both, so a tree may hold any
    share of them; ranges of a tree are added up from one row for each."""
    keys = ["tree", *order]
    by = [F.col(k).asc_nulls_first() for k in keys]
    place = F.monotonically_increasing_id()
    sorted_rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_place", place)
    placed = materialise(sorted_rows, "merkle-order").withColumn("_range", F.shiftright("_place", 33))
    ranges = placed.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        "tree", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
        F.sum("_n").over(whole).alias("n"),
    )
    return placed.join(starts, ["tree", "_range"]).withColumn("pos", F.col("_place") + F.col("_start")).drop("_place", "_range", "_start")


def blocks(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """``nodes`` (at least tree, pos, n, node) with the root of each node's block (``top``) and
    its witness there. A block of a larger tree has height ``bits``, also a short last one."""
    width = 1 << bits
    kind = pa.schema([("top", pa.binary()), ("witness", pa.binary())])

    def closed(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frontier = Frontier()
        for part in parts:
            for node in part["node"].to_pylist():
                frontier.append(node)
        top = frontier.close(None if parts[0]["n"][0].as_py() <= width else bits)
        at = 0
        for part in parts:
            witnesses = [bytes(w) for w in frontier.witnesses[at : at + part.num_rows]]
            at += part.num_rows
            more = [pa.array([top] * part.num_rows, pa.binary()), pa.array(witnesses, pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns, *more], schema=pa.schema([*part.schema, *kind]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        for batch in batches:
            cuts = np.flatnonzero(batch["pos"].to_numpy() % width == 0).tolist()
            begins = set(cuts)
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if parts and a in begins:
                    yield from closed(parts)
                    parts = []
                if b > a:
                    parts.append(batch.slice(a, b - a))
        if parts:
            yield from closed(parts)

    cut = nodes.withColumn("_block", F.shiftright("pos", bits))
    cut = cut.repartition("tree", "_block").sortWithinPartitions("tree", "pos").drop("_block")
    schema = ", ".join(f"{name} {kind}" for name, kind in cut.dtypes)
    return cut.mapInArrow(run, f"{schema}, top binary, witness binary")


def climbed(nodes: DataFrame, bits: int = BITS) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of all trees, level by level until each is one block, and ``tree``, ``root``."""
    width, levels, roots = 1 << bits, [], None
    while True:
        rows = materialise(blocks(nodes, bits), "merkle-level")
        levels.append(rows)
        done = rows.where((F.col("n") <= width) & (F.col("pos") == 0)).select("tree", F.col("top").alias("root"))
        roots = done if roots is None else roots.unionByName(done)
        nodes = rows.where((F.col("n") > width) & (F.col("pos") % width == 0)).select(
            "tree", F.shiftright("pos", bits).alias("pos"), F.ceil(F.col("n") / width).cast("long").alias("n"), F.col("top").alias("node")
        )
        if nodes.isEmpty():
            return levels, roots


def descended(levels: list[DataFrame], above: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows of the lowest level, their witnesses extended to the root of all: by that of
    their block, by that of its block, and so on; ``above`` has ``up``, what the tree's root
    needs above it, and other columns by tree, which are added too. Every row of a level is
    met by the rows of one block at most."""
    extras = [F.col(name) for name in above.columns if name not in ("tree", "up")]
    higher = None
    for level in reversed(levels):
        last = level.where(F.col("n") <= 1 << bits).join(above, "tree")
        if higher is not None:
            below = level.where(F.col("n") > 1 << bits).withColumn("_block", F.shiftright("pos", bits))
            last = last.unionByName(below.join(higher, ["tree", "_block"]).drop("_block"))
        whole = last.withColumn("witness", F.concat("witness", "up")).drop("up", "top")
        higher = whole.select("tree", F.col("pos").alias("_block"), F.col("witness").alias("up"), *extras)
    return whole


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, bits: int = BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, witness, subroot (of its language) and root, as
    bytes, and what ``extra`` expressions give."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    extra = extra or {}
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf_of().alias("node"),
        *(column.alias(name) for name, column in extra.items()),
    )
    with working(docs.sparkSession):
        levels, roots = climbed(numbered(leaves, ["doc_id", "node"]), bits)
        subroots = roots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), F.col("root").alias("node"))
        top_levels, root = climbed(numbered(subroots, ["lang"]), bits)
        above = descended(top_levels, root.select("tree", "root", F.lit(b"").alias("up")), bits).select(
            F.col("lang").alias("tree"), F.col("node").alias("subroot"), "root", F.col("witness").alias("up")
        )
        rows = descended(levels, materialise(above, "merkle-languages"), bits)
        rows = rows.select("doc_id", F.col("node").alias("leaf"), "witness", "subroot", "root", *extra)
        return materialise(rows, "manifest", keep=True)


def audited(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """Per row of ``docs`` the manifest as hex text, the hash of its siblings, and whether the
    row, tampered with where 7 divides the crc32 of its id, still leads to the root."""
    changed = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(changed, leaf_of(n_chars=F.col("n_chars") + 1))
    rows = manifest(docs, {"tampered": tampered}, bits)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch[name].to_pylist() for name in ("leaf", "witness", "subroot", "root", "tampered")}
            proofs, found = [], []
            for leaf, witness, other in zip(columns["leaf"], columns["witness"], columns["tampered"], strict=True):
                proofs.append(joined_hash(*(d for side, d in siblings(witness) if side != b"N")).hex())
                found.append(folded(other or leaf, witness))
            yield pa.record_batch({
                "doc_id": batch["doc_id"],
                **{name: pa.array([d.hex() for d in columns[name]], pa.string()) for name in ("leaf", "subroot", "root")},
                "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array([f.hex() for f in found], pa.string()),
                "verified": pa.array([f == r for f, r in zip(found, columns["root"], strict=True)], pa.bool_()),
            })

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return rows.mapInArrow(check, schema)
