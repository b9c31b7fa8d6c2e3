"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialise


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component``, the smallest id reachable, for each id in the links
    (columns ``a`` and ``b``) that is not the smallest of its component itself.

    Each round joins links with the smallest neighbour of their ends and is written to the
    shared folder; the number of rounds grows with the logarithm of the longest chain.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
        # every id links its larger neighbours to the smallest of all around it
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every id links its smaller neighbours, and itself, to the smallest of them
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = materialise(small.where("u <> v").distinct(), "links")
