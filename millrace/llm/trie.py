"""Prefix trie of conversations, by truncation peeling.

A node stands for a distinct sequence of the first turns of some conversations. Nodes are
found from the deepest up: at each depth the nodes that survive from below meet the
conversations that end there, equal ones become one node, and its last turn is stripped,
which makes it a survivor one turn shorter. All that is known of a node's subtree is added
up as it is met, so no prefix is ever made twice and no ancestors are listed.

Conversations travel as the 128-bit names of their prefixes, not as texts; equal ones are
one row from the start. A stretch of depths is peeled within a task per group of rows that
agree in the prefix above the stretch. Where such a group is too large for a task, the
stretch is halved, down to a single depth, which is a plain aggregate of Spark's; so a
prefix may be shared by any number of conversations.

Null roles and texts count as empty. Turns are ordered by number, null first; those of one
number by their names. Rows without a conversation are left out, a conversation given by
repeated rows has them as turns. A conversation's names are one row: 24 bytes a turn. An
empty table gives no nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise, working

#: Turns of all rows of a group that a task peels, at most.
GROUP_TURNS = 1 << 18
#: Ids whose text is one row of a node's list of ended conversations.
CHUNK_IDS = 1 << 16
ROOT = bytes(16)
EMPTY = sha256(b"").hexdigest()


def turns_of(rows: DataFrame) -> DataFrame:
    """conv_id and ``turns``: in order, the name of each turn's role and text (``x``, ``y``)
    and how many words it has. A text is read once and goes no further."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    named = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), F.xxhash64(F.lit(1), role, text).alias("x"),
            F.xxhash64(F.lit(2), text, role).alias("y"), words.alias("words"),
        ).alias("turn"),
    )
    return named.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def rebuilt(turns: DataFrame, base: Column, shared: Column, most: int) -> DataFrame:
    """Conversations whose first ``shared`` (``most`` at most) turns are those of the
    conversation ``base`` and whose own turns follow from there."""
    heads = turns.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    own = turns.withColumns({"_base": base, "_shared": shared})
    head = F.coalesce(F.slice(F.col("_head"), F.lit(1), F.col("_shared")), F.slice("turns", 1, 0))
    rest = F.slice(F.col("turns"), F.col("_shared") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return own.join(heads, "_base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


PATH = "conv_id long, path array<binary>, words array<long>"


def paths_of(turns: DataFrame) -> DataFrame:
    """conv_id, the names of all its prefixes from the shortest, and its turns' words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, words = [], []
            for turns in batch["turns"].to_pylist():
                name, path = ROOT, []
                for turn in turns:
                    own = turn["x"].to_bytes(8, "little", signed=True) + turn["y"].to_bytes(8, "little", signed=True)
                    name = blake2b(name + own, digest_size=16).digest()
                    path.append(name)
                paths.append(path)
                words.append([turn["words"] for turn in turns])
            yield pa.record_batch({
                "conv_id": batch["conv_id"], "path": pa.array(paths, pa.list_(pa.binary())),
                "words": pa.array(words, pa.list_(pa.int64())),
            })

    return turns.mapInArrow(run, PATH)


def name_at(depth: Column) -> Column:
    """The name of a path's prefix of some depth."""
    return F.when(depth < 1, F.lit(ROOT)).otherwise(F.get("path", depth - 1))


def ended(paths: DataFrame) -> DataFrame:
    """Per distinct conversation: name, depth, path, words, how many there are, the smallest id
    and the SHA-256 of all ids, ascending and joined by commas.

    A hash runs over its ids in order, so one task must see them; what it sees are texts of
    many ids each, written before by as many tasks as the ids need, and it keeps none."""
    rows = paths.select(name_at(F.size("path")).alias("name"), "conv_id")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ids = None, []

        def chunk() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_pylist([{"name": name, "first": ids[0], "n": len(ids), "ids": text}])

        for batch in batches:
            for key, conv in zip(batch["name"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (key != name or len(ids) >= CHUNK_IDS):
                    yield chunk()
                    ids = []
                name = key
                ids.append(conv)
        if ids:
            yield chunk()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = state = None
        n = first = 0
        done: list[dict] = []

        def one() -> dict:
            return {"name": name, "n": n, "conv_id": first, "ends": state.hexdigest()}

        for batch in batches:
            for row in batch.to_pylist():
                if row["name"] != name:
                    if state:
                        done.append(one())
                    name, state, n, first = row["name"], sha256(), 0, row["first"]
                state.update((("," if n else "") + row["ids"]).encode())
                n += row["n"]
            if done:
                yield pa.RecordBatch.from_pylist(done)
                done = []
        if state:
            yield pa.RecordBatch.from_pylist([one()])

    chunks = rows.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(
        listed, "name binary, first long, n long, ids string"
    )
    hashes = chunks.repartition("name").sortWithinPartitions("name", "first").mapInArrow(
        hashed, "name binary, n long, conv_id long, ends string"
    )
    return hashes.join(paths, "conv_id").select("name", F.size("path").alias("depth"), "path", "words", "n", "conv_id", "ends")


#: A row on its way up: a node, or what is known of it from one side. ``children``, ``leaves``
#: and ``saved`` are of the subtrees met below.
STATE = (
    "name binary, depth int, path array<binary>, words array<long>, n long, conv_id long, ends string, "
    "children long, leaves long, saved long"
)
NODE = "name binary, parent binary, depth int, n long, conv_id long, ends string, children long, leaves long, saved long"


def _merged(rows: DataFrame) -> DataFrame:
    """Rows of one depth, one for each name, with their own part of the sums added."""
    one = rows.groupBy("name").agg(
        F.first("depth").alias("depth"), F.first("path").alias("path"), F.first("words").alias("words"),
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"),
        F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
    )
    own = F.when(F.col("depth") > 0, (F.col("n") - 1) * F.get("words", F.col("depth") - 1)).otherwise(0)
    return one.withColumns({"leaves": F.greatest("leaves", F.lit(1)), "saved": F.col("saved") + own})


def _as_nodes(rows: DataFrame) -> DataFrame:
    parent = F.when(F.col("depth") > 0, name_at(F.col("depth") - 1))
    return rows.select("name", parent.alias("parent"), *(part.split()[0] for part in NODE.split(", ")[2:]))


def _stripped(rows: DataFrame) -> DataFrame:
    """Survivors: each node as what its parent knows of it."""
    shorter = F.col("depth") - 1
    return rows.select(
        name_at(shorter).alias("name"), shorter.cast("int").alias("depth"), "path", "words", "n", "conv_id",
        F.lit(None).cast("string").alias("ends"), F.lit(1).cast("long").alias("children"), "leaves", "saved",
    )


def peel(rows: dict[bytes, dict], depth: int, nodes: list[dict]) -> dict[bytes, dict]:
    """One depth in memory: adds its nodes to ``nodes``, gives the survivors by name."""
    above: dict[bytes, dict] = {}
    for name, row in rows.items():
        row["leaves"] = max(row["leaves"], 1)
        row["saved"] += (row["n"] - 1) * row["words"][depth - 1]
        parent = row["path"][depth - 2] if depth > 1 else ROOT
        nodes.append({**row, "name": name, "parent": parent, "depth": depth})
        add(above, {**row, "name": parent, "ends": None, "children": 1})
    return above


def add(rows: dict[bytes, dict], row: dict) -> None:
    known = rows.setdefault(row["name"], row)
    if known is not row:
        for key in ("n", "children", "leaves", "saved"):
            known[key] += row[key]
        known["conv_id"] = min(known["conv_id"], row["conv_id"])
        known["ends"] = known["ends"] or row["ends"]


def _peeled_in_tasks(rows: DataFrame, floor: int) -> DataFrame:
    """Groups that agree in the first ``floor`` turns, peeled down to there: their nodes, and
    one survivor each, as rows of ``STATE`` with the node's ``parent`` (null for survivors)."""
    state = pa.schema([
        ("name", pa.binary()), ("depth", pa.int32()), ("path", pa.list_(pa.binary())), ("words", pa.list_(pa.int64())),
        ("n", pa.int64()), ("conv_id", pa.int64()), ("ends", pa.string()), ("children", pa.int64()), ("leaves", pa.int64()),
        ("saved", pa.int64()), ("parent", pa.binary()),
    ])

    def run(table: pa.Table) -> pa.Table:
        waiting: dict[int, list[dict]] = {}
        for row in table.drop(["top"]).to_pylist():
            waiting.setdefault(row["depth"], []).append(row)
        nodes: list[dict] = []
        rows: dict[bytes, dict] = {}
        for depth in range(max(waiting), floor, -1):
            for row in waiting.pop(depth, []):
                add(rows, row)
            rows = peel(rows, depth, nodes)
        for node in nodes:
            node["path"] = node["words"] = None
        left = [{**row, "depth": floor, "parent": None} for row in rows.values()]
        return pa.Table.from_pylist(nodes + left, schema=state)

    return rows.withColumn("top", name_at(F.lit(floor))).groupBy("top").applyInArrow(run, f"{STATE}, parent binary")


def _peeled(rows: DataFrame, floor: int, top: int, found: list[DataFrame], group_turns: int) -> DataFrame | None:
    """Peels rows of depths above ``floor`` up to ``top``; adds tables of nodes to ``found`` and
    gives the survivors at ``floor``, null if there are no rows."""
    if rows.isEmpty():
        return None
    if top - floor == 1:
        merged = materialise(_merged(rows), "trie-depth")
        found.append(_as_nodes(merged))
        return _stripped(merged)
    keyed = rows.withColumn("_top", name_at(F.lit(floor)))
    sizes = keyed.groupBy("_top").agg(F.sum("depth").alias("_turns"))
    large = materialise(sizes.where(F.col("_turns") > group_turns).select("_top"), "trie-large")
    some = not large.isEmpty()
    small = keyed.join(large, "_top", "left_anti").drop("_top") if some else rows
    done = materialise(_peeled_in_tasks(small, floor), "trie-stretch")
    found.append(done.where("parent IS NOT NULL").select(*(part.split()[0] for part in NODE.split(", "))))
    survivors = done.where("parent IS NULL").drop("parent")
    if some:
        rest = materialise(keyed.join(large, "_top", "left_semi").drop("_top"), "trie-rows")
        middle = (floor + top) // 2
        upper = _peeled(rest.where(F.col("depth") > middle), middle, top, found, group_turns)
        lower = rest.where(F.col("depth") <= middle)
        lower = lower if upper is None else materialise(lower.unionByName(upper), "trie-rows")
        more = _peeled(lower, floor, middle, found, group_turns)
        survivors = survivors if more is None else survivors.unionByName(more)
    return survivors


def nodes_of(paths: DataFrame, group_turns: int = GROUP_TURNS) -> DataFrame:
    """The nodes of the trie over ``paths`` (conv_id, path, words): name, parent (of the root
    null), depth, n, conv_id, ends, children, leaves and saved."""
    none = F.lit(0).cast("long")
    rows = materialise(ended(paths).withColumns({"children": none, "leaves": none, "saved": none}), "trie-ended")
    deepest = rows.agg(F.max("depth")).first()[0]
    found: list[DataFrame] = []
    if deepest is not None:
        left = _peeled(rows.where("depth > 0"), 0, deepest, found, group_turns) if deepest else None
        whole = rows.where("depth = 0")
        found.append(_as_nodes(_merged(whole if left is None else whole.unionByName(left))))
    out = found[0] if found else _as_nodes(rows)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def trie(rows: DataFrame, base: Column, shared: Column, most: int, group_turns: int = GROUP_TURNS) -> DataFrame:
    """Per node: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256."""
    with working(rows.sparkSession):
        paths = materialise(paths_of(rebuilt(materialise(turns_of(rows), "trie-turns"), base, shared, most)), "trie-paths")
        nodes = materialise(nodes_of(paths, group_turns), "trie-nodes", keep=True)
    parents = nodes.where("children > 0").select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "parent", "left").select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"),
    )


def shared_starts(rows: DataFrame) -> DataFrame:
    """The trie of conversations that begin as the first of their score does, for none to three
    turns, by the checksum of their id."""
    id_text = F.col("conv_id").cast("string").cast("binary")
    return trie(rows, F.col("conv_id") - F.col("conv_id") % 20, (F.crc32(id_text) % 4).cast("int"), 3)
