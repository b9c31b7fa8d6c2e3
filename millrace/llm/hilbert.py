"""Sharding along a Hilbert curve over several metadata dimensions, by DataFrame operations.

Each dimension is quantised to 16 levels, the cell of a document gets its index on the
curve, documents are ordered by that index, and the order is cut into runs of equal
counts. Neighbours on the curve are near in every dimension, so a filter on any of them
meets few shards' value ranges.

Text columns are quantised by the share of documents up to their value, numbers by the
power of two. Within a cell the order is by a hash of the id, then the id itself. A null
text has size 1 and the checksum of an empty one; a null language or source counts as
empty. An empty table gives no shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.prefixes import id_hash, prefix_sums
from millrace.session import materialise

SHARDS = 16
BITS = 4
DIMENSIONS = ("lang", "source", "size")


def curve_steps(axes: list[str], bits: int = BITS) -> list[dict[str, str]]:
    """SQL expressions, step by step, that turn the coordinates in the columns ``axes``
    into ``curve``, the cell's index on the Hilbert curve through them (Skilling's
    transform: undo the excess work from the top bit down, Gray-code, interleave)."""
    flip = lambda a, b: f"(({a} | {b}) - ({a} & {b}))"  # noqa: E731  exclusive or, in any dialect
    head, *_, last = axes
    steps = []
    for bit in range(bits - 1, 0, -1):
        high, low = 1 << bit, (1 << bit) - 1
        for axis in axes:
            if axis == head:
                steps.append({head: f"CASE WHEN ({head} & {high}) > 0 THEN {flip(head, low)} ELSE {head} END"})
                continue
            swap = f"({flip(head, axis)} & {low})"
            steps.append({
                head: f"CASE WHEN ({axis} & {high}) > 0 THEN {flip(head, low)} ELSE {flip(head, swap)} END",
                axis: f"CASE WHEN ({axis} & {high}) > 0 THEN {axis} ELSE {flip(axis, swap)} END",
            })
    steps += [{axis: flip(axis, before)} for before, axis in zip(axes, axes[1:], strict=False)]
    turn = "0"
    for bit in range(bits - 1, 0, -1):
        steps.append({"turn": f"CASE WHEN ({last} & {1 << bit}) > 0 THEN {flip(turn, (1 << bit) - 1)} ELSE {turn} END"})
        turn = "turn"
    steps.append({axis: flip(axis, "turn") for axis in axes})
    woven = [
        f"(({axis} & {1 << bit}) * {1 << (bit * len(axes) + len(axes) - 1 - k - bit)})"
        for bit in range(bits - 1, -1, -1) for k, axis in enumerate(axes)
    ]
    steps.append({"curve": " + ".join(woven)})
    return steps


def with_curve(cells: DataFrame, axes: list[str], bits: int = BITS) -> DataFrame:
    """Adds ``curve`` to rows with coordinates ``axes``, which stay as they are."""
    work = [f"_{axis}" for axis in axes]
    out = cells.selectExpr("*", *(f"CAST({axis} AS BIGINT) AS _{axis}" for axis in axes))
    for step in curve_steps(work, bits):
        out = out.withColumns({name: F.expr(sql) for name, sql in step.items()})
    return out.drop(*work, "turn")


def levels(values: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """``name`` and its ``<name>_level`` by the share of rows with a smaller value. One row
    per distinct value of the column goes through the ordering."""
    counted = values.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(order), F.lit(0))
    everything = F.sum("_n").over(Window.partitionBy(F.lit(1)))
    return counted.select(name, F.floor(before * (1 << bits) / everything).cast("long").alias(f"{name}_level"))


def size_level(size: Column, bits: int = BITS) -> Column:
    return F.least(F.length(F.bin(size)) - 1, F.lit((1 << bits) - 1)).cast("long")


def placed(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row of ``docs``: doc_id, size (UTF-8 bytes and 1), text_crc32, curve, shard and
    slot within the shard. Shards' counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = materialise(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
            *(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source")),
            id_hash().alias("hash"),
        ),
        "shard-rows",
    )
    leveled = slim.withColumn("size_level", size_level(F.col("size")))
    for name in ("lang", "source"):
        leveled = leveled.join(levels(slim, name), name)
    axes = [f"{name}_level" for name in DIMENSIONS]
    # at most 16^3 cells, so their curve is worked out once and sent along
    cells = with_curve(leveled.select(*axes).distinct(), axes)
    rows = materialise(
        leveled.join(F.broadcast(cells), axes).select("doc_id", "size", "text_crc32", "hash", "curve", F.lit(1).cast("long").alias("one")),
        "shard-cells",
    )
    total = F.lit(max(rows.count(), 1))
    ranked = prefix_sums(rows, [], ["curve"], "one", ["doc_id", "text_crc32", "size"], "rank", few=True)
    shard = F.floor(F.col("rank") * shards / total).cast("int")
    first = F.ceil(F.col("shard") * total / shards).cast("long")
    return ranked.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", "curve", "shard", (F.col("rank") - first).alias("slot")
    )
