"""Mixing sources to target weights by systematic sampling.

Each source's words are to come near a target. A document is expected to be taken
target / source size times; these expectations are added up within the source, in the
order of size classes, a random offset is added once, and a document is emitted once for
each whole number that its stretch of the sum crosses. Sums are whole numbers (units of
2^-26 copies), so every crossing is counted exactly once and reruns agree.

A document without words, or with a null text, has size 0 and is never taken; a source
without words has target 0.
An empty table gives an empty mix. Repeated rows are sampled as documents of their own.
Up to 4.5 * 10^10 documents of one source fit the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.prefixes import id_hash, prefix_sums
from millrace.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
UNIT = 1 << 26
MOST = 3
SEED = 20


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Eight classes between each power of two and the next, in order of size."""
    shift = F.length(F.bin(size)) - 4
    return F.when(size < 8, size).otherwise((shift + 1) * 8 + F.floor(size / F.pow(F.lit(2.0), shift)) - 8).cast("long")


def cyclic_weights(sources: DataFrame) -> DataFrame:
    """Adds ``weight``: 1, 2, 3 and again, by the sources' names in code point order, null
    last. One row per source goes through the ordering."""
    names = Window.orderBy(F.col("source").asc_nulls_last())
    return sources.withColumn("weight", ((F.row_number().over(names) - 1) % 3 + 1).cast("double"))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target``: the words of all sources shared by ``weight``, no source getting
    more than ``most`` times its own, what is left reshared by weight.

    Sources reach their limit in the order of limit to weight. The level that the others
    share is the first one that doesn't exceed its own source's ratio, and those after it
    are lower.
    """
    limit = F.col("source_size") * F.lit(float(most))
    rows = sources.withColumn("_ratio", limit / F.col("weight"))
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("_all", F.sum("source_size").over(everything)).withColumn(
        "_level",
        (F.col("_all") - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("weight").over(onwards),
    )
    rows = rows.withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything))
    shared = F.coalesce(F.col("_level") * F.col("weight"), limit)
    return rows.withColumn("target", F.least(limit, shared)).drop("_ratio", "_all", "_level")


def copies(docs: DataFrame, weigh=cyclic_weights, most: int = MOST, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target and copies, how often
    the mix takes the document. ``weigh`` adds ``weight`` to one row per source."""
    slim = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), words_in(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("check"),
    )
    # null is a source of its own: every name has a mark before it
    named = slim.withColumn("key", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source"))))
    slim = materialise(named.withColumns({"hash": id_hash(), "class": size_class(F.col("size"))}), "mix-sizes")
    sources = weigh(slim.groupBy("key", "source").agg(F.sum("size").alias("source_size")))
    aims = targets(sources, most).select(
        "key", "source_size", "target",
        F.round(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * UNIT)
        .cast("long").alias("units"),
        F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("key")).cast("binary")), 1, 8), 16, 10)
        .cast("long").alias("offset"),
    )
    units = F.when(F.col("size") > 0, F.col("units")).otherwise(0).cast("long")
    aimed = materialise(slim.join(aims, "key").withColumn("units", units), "mix-expected")
    placed = prefix_sums(aimed, ["key"], ["class"], "units", ["doc_id", "check"], "before")
    start = F.col("before") + F.shiftright("offset", 6)  # an offset below one copy
    taken = (F.shiftright(start + F.col("units"), 26) - F.shiftright(start, 26)).cast("long")
    return placed.select("doc_id", "source", "size", "source_size", "target", "check", taken.alias("copies"))


def mixed(docs: DataFrame, weigh=cyclic_weights, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes it.

    Counts find their rows again by id, source and checksum of the text; rows that agree
    in all three share their copies evenly."""
    keys = ["_mix_id", "_mix_source", "_mix_check"]

    def keyed(df: DataFrame, check: Column) -> DataFrame:
        source = F.col("source").cast("string")
        return df.withColumns({
            "_mix_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            "_mix_source": F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source)),
            "_mix_check": check,
        })

    counted = keyed(copies(docs, weigh, most, seed), F.col("check")).groupBy(*keys).agg(
        F.sum("copies").alias("_mix_copies"), F.count(F.lit(1)).alias("_mix_rows")
    )
    rows = keyed(docs, F.crc32(F.coalesce(F.col("text"), F.lit("")))).join(counted.where("_mix_copies > 0"), keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_mix_copies")).cast("long")
    share = F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + (place <= F.col("_mix_copies") % F.col("_mix_rows")).cast("long")
    rows = rows.withColumn("_mix_times", share).where("_mix_times > 0")
    return rows.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times").cast("int")))).select(
        *(F.col(f"`{name}`") for name in docs.columns)
    )
