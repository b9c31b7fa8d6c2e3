"""Session settings and the shared working folder."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings a job should start with; none of them is tuned to a data size.
# Shuffle partition counts are left to the cluster and to adaptive execution.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Set when a session starts: recording the call site of every column expression
# slows down plan building.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

# Incremental state on the checkpoint's file system.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**START_CONF, **JOB_CONF, **STATE_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session on the same context with the streaming settings applied,
    leaving the caller's own session settings alone."""
    sibling = spark.newSession()
    for key, value in {**JOB_CONF, **STATE_CONF}.items():
        sibling.conf.set(key, value)
    return sibling


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or else the
    warehouse, through whichever file system that names."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


# Tables that the open ``working`` blocks have written, from the outermost to the innermost.
_WORKING: ContextVar[tuple[list[str], ...]] = ContextVar("millrace_working", default=())


@contextmanager
def working(spark: SparkSession) -> Iterator[None]:
    """Owns the tables that ``materialise`` writes within the block and removes them at its
    end. Only what is written out within the block, or kept, may be read after it.

    A job that never ends wraps each batch in one, so that its working folder does not grow.
    """
    mine: list[str] = []
    token = _WORKING.set((*_WORKING.get(), mine))
    try:
        yield
    finally:
        _WORKING.reset(token)
        for path in mine:
            remove_path(spark, path)


def materialise(df: DataFrame, label: str, keep: bool = False, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that a lost executor never repeats the work before it,
    and gives the planner true file sizes to choose join strategies by. The table belongs
    to the innermost ``working`` block, with ``keep`` to the one around that; where there is
    none it stays until ``remove_older`` takes it. ``codec`` is Parquet's, the session's by
    default; texts take about two thirds of the disk with ``zstd``.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    owners = _WORKING.get()[: -1 if keep else None]
    if owners:
        owners[-1].append(path)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def remove_older(spark: SparkSession, hours: float) -> int:
    """Remove what the working folder has had for so many hours, and say how many tables that
    was. For tables that returned DataFrames read: call it when none so old is in use."""
    folder = f"{shared_dir(spark)}/millrace"
    fs, hadoop_path = _file_system(spark, folder)
    if not fs.exists(hadoop_path):
        return 0
    before = time.time() * 1000 - hours * 3_600_000
    old = [status.getPath() for status in fs.listStatus(hadoop_path) if status.getModificationTime() < before]
    return sum(fs.delete(path, True) for path in old)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, hadoop_path = _file_system(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def remove_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder and what is in it; whether there was one."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.delete(hadoop_path, True)
