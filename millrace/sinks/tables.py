"""Batches into a folder of files, rows and source offsets committed together.

Layout: ``rows/run=R/batch_id=N/kind=K`` holds the rows and
``offsets/run=R/batch_id=N`` the newest offset per source partition, ``R`` being the
streaming query. The offsets are written last and mark the batch as committed:
readers see the rows of marked batches only. Writing a batch again replaces it, so a
replay neither loses nor repeats rows. A query with a new checkpoint, started from
``stored_offsets``, goes on in the same folder.

``compact_folder`` gathers them in a ledger, ``history/snapshot=N``, which does not grow with
the batches: per query run and source partition the newest offset and which batches it
stands for. A run commits its batches in order, so these are an interval. Readers take the
newest whole ledger and the batches after its intervals that have a folder of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.offsets import newest
from millrace.operators.route import ROUTED_SCHEMA
from millrace.session import child_names, path_exists, remove_path
from millrace.sinks.batches import WriteBatch, run_of

_OFFSETS_SCHEMA = (
    "topic string, partition_value int, offset_value bigint, insert_time timestamp, "
    "run string, batch_id bigint"
)
_LEDGER_SCHEMA = (
    "run string, topic string, partition_value int, offset_value bigint, insert_time timestamp, "
    "first_batch bigint, last_batch bigint"
)


def commit_to_folder(root: str) -> WriteBatch:
    """A ``foreachBatch`` writer of routed rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = f"run={run_of(batch)}/batch_id={batch_id}"
        rows, offsets = f"{root}/rows/{place}", f"{root}/offsets/{place}"
        if path_exists(spark, f"{offsets}/_SUCCESS"):
            return
        _replace(batch, rows, "kind")
        written = spark.read.schema(ROUTED_SCHEMA).parquet(rows)
        _replace(newest(written).withColumn("insert_time", F.current_timestamp()), offsets)

    return write


def _replace(df: DataFrame, path: str, *partitions: str) -> None:
    # static: nothing of an earlier attempt stays, whatever the session says
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def stored_offsets(spark: SparkSession, root: str) -> DataFrame:
    """The newest offsets of the committed batches: of those in the ledger per run, under the
    number of its last batch there, of later ones per batch."""
    own = _read(spark, f"{root}/offsets", _OFFSETS_SCHEMA)
    ledger = _ledger(spark, root)
    if ledger is None:
        return own
    kept = ledger.withColumnRenamed("last_batch", "batch_id").select(*own.columns)
    return kept.unionByName(_after(own, ledger))


def committed_batches(spark: SparkSession, root: str) -> DataFrame:
    """Intervals of the committed batches: run, first_batch and last_batch; of a run one from
    the ledger, and one for each batch after it."""
    own = _read(spark, f"{root}/offsets", _OFFSETS_SCHEMA)
    ledger = _ledger(spark, root)
    later = own if ledger is None else _after(own, ledger)
    each = later.select("run", F.col("batch_id").alias("first_batch"), F.col("batch_id").alias("last_batch")).distinct()
    return each if ledger is None else each.unionByName(ledger.select("run", "first_batch", "last_batch").distinct())


def committed_rows(spark: SparkSession, root: str) -> DataFrame:
    """The routed rows of the committed batches."""
    rows = _read(spark, f"{root}/rows", f"{ROUTED_SCHEMA}, run string, batch_id bigint")
    batches = committed_batches(spark, root).withColumnRenamed("run", "_run")
    inside = (F.col("run") == F.col("_run")) & F.col("batch_id").between(F.col("first_batch"), F.col("last_batch"))
    return rows.join(batches, inside, "left_semi")


def compact_folder(spark: SparkSession, root: str, keep: int = 10) -> int:
    """Bring the ledger up to date and remove the folders of the batches in it, but for the
    last ``keep`` of each run, which a restart may still ask for. Returns how many folders
    went. Run it now and then, one at a time; a run cut short is made up by the next."""
    own = _read(spark, f"{root}/offsets", _OFFSETS_SCHEMA)
    known, before = own.withColumns({"first_batch": F.col("batch_id"), "last_batch": F.col("batch_id")}).drop("batch_id"), _ledger(spark, root)
    if before is not None:
        known = known.unionByName(before)
    batches = known.groupBy("run").agg(F.min("first_batch").alias("first_batch"), F.max("last_batch").alias("last_batch"))
    offsets = known.groupBy("run", "topic", "partition_value").agg(
        F.max("offset_value").alias("offset_value"), F.max("insert_time").alias("insert_time")
    )
    last = _last_snapshot(spark, root)
    number = 0 if last is None else last + 1
    _replace(offsets.join(batches, "run"), f"{root}/history/snapshot={number}")
    removed = 0
    # a row per run, and of its batches only those that still have a folder
    for row in _ledger(spark, root).select("run", "last_batch").distinct().toLocalIterator():
        for name in child_names(spark, f"{root}/offsets/run={row.run}"):
            if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= row.last_batch - keep:
                removed += remove_path(spark, f"{root}/offsets/run={row.run}/{name}")
    for name in child_names(spark, f"{root}/history"):
        if name.startswith("snapshot=") and int(name.removeprefix("snapshot=")) < number:
            remove_path(spark, f"{root}/history/{name}")
    return removed


def _ledger(spark: SparkSession, root: str) -> DataFrame | None:
    number = _last_snapshot(spark, root)
    return None if number is None else spark.read.schema(_LEDGER_SCHEMA).parquet(f"{root}/history/snapshot={number}")


def _after(own: DataFrame, ledger: DataFrame) -> DataFrame:
    """The offsets of batches that the ledger does not stand for."""
    batches = ledger.select(F.col("run").alias("_run"), "last_batch").distinct()
    return own.join(batches, (F.col("run") == F.col("_run")) & (F.col("batch_id") <= F.col("last_batch")), "left_anti")


def _last_snapshot(spark: SparkSession, root: str) -> int | None:
    """The newest snapshot that was written to its end."""
    numbers = [int(name.removeprefix("snapshot=")) for name in child_names(spark, f"{root}/history") if name.startswith("snapshot=")]
    whole = [n for n in numbers if path_exists(spark, f"{root}/history/snapshot={n}/_SUCCESS")]
    return max(whole, default=None)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not child_names(spark, path):
        return spark.createDataFrame([], T.StructType.fromDDL(schema))
    return spark.read.schema(schema).parquet(path)
