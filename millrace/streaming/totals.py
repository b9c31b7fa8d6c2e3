"""Keyed running totals on a stream, one updated total per input row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.operators.aggregate import keyed_totals
from millrace.operators.ranges import ROWS_PER_RANGE
from millrace.operators.running import of_keys, running_totals
from millrace.session import child_names, materialise, remove_path, working
from millrace.sinks.batches import WriteBatch

#: Parts that the totals are kept in, by a hash of the key.
BUCKETS = 16
_BUCKET = "_bucket"


def changelog_to_folder(
    root: str,
    keys: list[str],
    order: list[str],
    name: str,
    value: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
    buckets: int = BUCKETS,
) -> WriteBatch:
    """A ``foreachBatch`` writer of the changelog of a keyed sum of ``value``, or of a
    keyed row count.

    A batch is worked on in ranges like a table, so a hot key is spread over tasks, and
    starts from the totals of its own keys that the batches before left. Rows with their
    totals go to ``changes/batch_id=N``.

    Totals are kept in buckets of keys and at two levels: the totals of a batch's keys go to
    ``new/batch_id=N``, and each batch merges one bucket, in turn, into
    ``merged/_bucket=B/upto=N``. So a batch reads the buckets that it has keys in, each from
    its last merge on, and moves one in ``buckets``; what every bucket has merged is removed.
    A replayed batch reads the same and replaces its own. ``root`` belongs to one
    checkpoint, as batch numbers do, and ``buckets`` stays what it was at first.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with working(spark):
            rows = materialise(with_bucket(batch, keys, buckets), "changelog-batch")
            touched = [r[0] for r in rows.select(_BUCKET).distinct().collect()]  # numbers below ``buckets``
            rows = rows.drop(_BUCKET)
            own_totals = keyed_totals(rows, keys, name, value) if value else keyed_totals(rows, keys, name)
            before = totals_before(spark, root, own_totals.schema, batch_id, touched, buckets)
            initial = None
            if before is not None:
                # keys of the batch only, before anything is shuffled by them
                initial = latest_totals(of_keys(before, rows, keys), keys, name)
            changes = running_totals(rows, keys, order, name, value, initial, rows_per_range)
            changes.write.mode("overwrite").parquet(f"{root}/changes/batch_id={batch_id}")
            totals = own_totals
            if initial is not None:
                totals = totals.unionByName(initial).groupBy(*keys).agg(F.sum(name).alias(name))
            by_bucket(with_bucket(totals, keys, buckets), f"{root}/new/batch_id={batch_id}")
        merge_one_bucket(spark, root, own_totals.schema, batch_id, buckets, lambda found: latest_totals(found, keys, name))

    return write


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def by_bucket(df: DataFrame, path: str) -> None:
    # rebalanced: a file or a few per bucket, whatever their sizes
    writer = df.hint("rebalance", _BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(_BUCKET).parquet(path)


def merge_one_bucket(
    spark: SparkSession, root: str, schema: T.StructType, batch_id: int, buckets: int,
    latest: Callable[[DataFrame], DataFrame],
) -> None:
    """Merge the bucket whose turn it is, by ``latest``, and remove what no batch will read."""
    own = batch_id % buckets
    found = totals_before(spark, root, schema, batch_id + 1, [own], buckets, batch_id - buckets)
    if found is not None:
        latest(found).write.mode("overwrite").parquet(f"{root}/merged/{_BUCKET}={own}/upto={batch_id}")
    # the batch before will not come again, so what only it would read can go
    remove_path(spark, f"{root}/new/batch_id={batch_id - buckets - 1}")
    remove_path(spark, f"{root}/merged/{_BUCKET}={(batch_id - 1) % buckets}/upto={batch_id - 1 - buckets}")


def totals_before(
    spark: SparkSession, root: str, schema: T.StructType, batch_id: int, touched: list[int], buckets: int,
    merged_at: int | None = None,
) -> DataFrame | None:
    """What the batches before this one left in some buckets, with the ``batch_id`` that each
    total is of: each bucket's last merge, or that of ``merged_at``, and what is newer."""
    newer = merged = F.lit(False)
    for bucket in touched:
        # the last batch before this one whose turn the bucket was
        at = batch_id - 1 - (batch_id - 1 - bucket) % buckets if merged_at is None else merged_at
        newer = newer | ((F.col(_BUCKET) == bucket) & (F.col("batch_id") > at))
        merged = merged | ((F.col(_BUCKET) == bucket) & (F.col("upto") == at))
    def kept(folder: str, number: str, which: Column) -> DataFrame:
        # of files partitioned by bucket and number, so only the folders asked for are read
        fields = T.StructType([*schema, T.StructField(number, T.LongType()), T.StructField(_BUCKET, T.IntegerType())])
        rows = spark.read.schema(fields).parquet(f"{root}/{folder}").where(which)
        return rows.select(*schema.names, F.col(number).alias("batch_id"))

    if not child_names(spark, f"{root}/new"):
        return None
    found = kept("new", "batch_id", newer & (F.col("batch_id") < batch_id))
    if child_names(spark, f"{root}/merged"):
        found = found.unionByName(kept("merged", "upto", merged))
    return found


def updates_to_folder(root: str) -> WriteBatch:
    """A ``foreachBatch`` writer for output mode ``update``: the totals a batch
    changed go to ``batch_id=N``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return write


def latest_totals(updates: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The last total of each key among totals written by batch."""
    return updates.groupBy(*keys).agg(F.max_by(name, "batch_id").alias(name))
