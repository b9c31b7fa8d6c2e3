"""Service lookups on a stream, with answers kept between batches."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.enrich import Fetch, ask_service, check_lookup, lookup_join
from millrace.operators.running import of_keys
from millrace.session import child_names, materialise, working
from millrace.sinks.batches import WriteBatch
from millrace.streaming.totals import BUCKETS, by_bucket, merge_one_bucket, totals_before, with_bucket

_UNTIL = "_until"


def answers_to_folder(
    root: str,
    key: str,
    name: str,
    fetch: Fetch,
    keep: float = 86_400.0,
    keep_failed: float = 60.0,
    on_error: str = "null",
    tasks: int | None = None,
    buckets: int = BUCKETS,
    clock: Callable[[], float] = time.time,
) -> WriteBatch:
    """A ``foreachBatch`` writer of each row with ``name``, the service's answer for ``key``,
    and ``<name>_error``, to ``rows/batch_id=N``.

    Answers are kept for ``keep`` seconds, failures for ``keep_failed``; only keys without a
    kept answer are asked for, once each, in as many ``tasks`` as there are cores by default.
    ``fetch``, ``on_error`` and null keys are as in ``service_lookup``.

    They lie in buckets by a hash of the key, at the two levels of ``changelog_to_folder``: a
    batch reads the buckets it has keys in and merges one in turn, leaving out what has
    expired. Answers are written before the rows, so a batch that is cut short and comes again
    asks for nothing that it has been told. ``root`` belongs to one checkpoint.
    """
    error = f"{name}_error"
    kept = T.StructType([T.StructField(c, T.StringType()) for c in (key, name, error)] + [T.StructField(_UNTIL, T.LongType())])

    def latest(answers: DataFrame, now: int) -> DataFrame:
        newest = F.max_by(F.struct(name, error, _UNTIL, "batch_id"), "batch_id").alias("_last")
        return answers.groupBy(key).agg(newest).select(key, "_last.*").where(F.col(_UNTIL) > now)

    def write(batch: DataFrame, batch_id: int) -> None:
        check_lookup(batch, key, on_error)
        spark, now = batch.sparkSession, int(clock() * 1000)
        with working(spark):
            rows = materialise(batch, "lookup-batch")
            keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
            keys = materialise(with_bucket(keys, [key], buckets), "lookup-keys")
            touched = [r[0] for r in keys.select("_bucket").distinct().collect()]  # numbers below ``buckets``
            keys = keys.drop("_bucket")
            known = own_answers(spark, f"{root}/new/batch_id={batch_id}", kept, batch_id)
            before = totals_before(spark, root, kept, batch_id, touched, buckets)
            if before is not None:
                known = known.unionByName(before)
            known = materialise(latest(of_keys(known, keys, [key]), now), "known-answers")
            unknown = keys.join(known, key, "left_anti").repartition(tasks or spark.sparkContext.defaultParallelism)
            seconds = F.when(F.col(error).isNull(), keep).otherwise(keep_failed)
            until = (F.lit(now) + seconds * 1000).cast("bigint")
            asked = ask_service(unknown, key, name, fetch, on_error).withColumn(_UNTIL, until)
            asked = materialise(asked, "answers")
            own = asked.unionByName(known.where(F.col("batch_id") == batch_id).select(*kept.names))
            by_bucket(with_bucket(own, [key], buckets), f"{root}/new/batch_id={batch_id}")
            answers = asked.unionByName(known.select(*kept.names)).drop(_UNTIL)
            lookup_join(rows, answers, key).write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")
        merge_one_bucket(spark, root, kept, batch_id, buckets, lambda found: latest(found, now).select(*kept.names))

    return write


def own_answers(spark: SparkSession, path: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """What an earlier attempt at this batch was told."""
    found = spark.read.schema(schema).parquet(path) if child_names(spark, path) else spark.createDataFrame([], schema)
    return found.select(*schema.names).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
