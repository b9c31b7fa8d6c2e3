"""Prefix sums over a total order, by DataFrame operations and without one long partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Row hashes are below this.
HASHES = 1 << 32


def id_hash(salt: str = "") -> Column:
    """32 bits of the md5 of the id as text; a null id counts as empty."""
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def prefix_sums(df: DataFrame, within: list[str], classes: list[str], value: str, ties: list[str], out: str, few: bool = False) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one, within ``within``,
    in the order of ``classes``, then ``hash`` (a column below 2^32), then ``ties``.

    Rows of a class are cut into runs of hashes in proportion to their number, as many in
    all as there are shuffle partitions; each run is summed up, the sums of runs are added
    up by class, and only within a run are rows put in order. So a class may hold any
    share of the rows, and neither the runs nor their number changes the result. ``df`` is
    read three times: give a written table. Columns of ``within`` and ``classes`` must not
    be null. ``few``: the classes are known to be few, and go to all tasks.
    """
    keys = [*within, *classes]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = max(df.count(), 1)
    runs = rows.select(*keys, F.ceil(F.col("_n") * F.lit(width) / F.lit(total)).cast("long").alias("_runs"))
    cut = df.join(F.broadcast(runs) if few else runs, keys).withColumn("_run", F.floor(F.col("hash") * F.col("_runs") / F.lit(HASHES)).cast("long"))
    sums = cut.groupBy(*keys, "_run").agg(F.sum(value).alias("_sum"))
    order = Window.partitionBy(*within).orderBy(*classes, "_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_run", F.coalesce(F.sum("_sum").over(order), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_run").orderBy("hash", *ties).rowsBetween(Window.unboundedPreceding, -1)
    # dealt out anew by run: the join's partitions have whole classes
    placed = cut.repartition(width, *keys, "_run").withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return placed.join(starts, [*keys, "_run"]).withColumn(out, F.col("_start") + F.col("_inside")).drop(
        "_runs", "_run", "_start", "_inside"
    )
