"""Sinks with a life per task: opened, given rows, closed, and committed by the driver."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery


class TaskSink(Protocol):
    """``open``, ``invoke``, ``close`` and ``cancel`` are called in a task, on a sink of its own;
    ``commit`` and ``abort`` once a batch, at the driver, with what ``close`` returned in the
    tasks whose results count.

    Nothing that a task does may show before ``commit``: tasks are repeated, and some run
    twice at a time. A batch may be committed again after a restart, with other messages,
    and then replaces what it gave first.
    """

    def open(self) -> None: ...
    def invoke(self, rows: pa.RecordBatch) -> None: ...
    def close(self) -> object: ...
    def cancel(self) -> None: ...
    def commit(self, batch_id: int, messages: list) -> None: ...
    def abort(self, batch_id: int, messages: list) -> None: ...


@dataclass
class _Message(WriterCommitMessage):
    value: object


def start_sink(
    df: DataFrame, make: Callable[[], TaskSink], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write a stream through sinks that ``make`` gives; starts and stops like ``start_batches``.
    A task that fails is cancelled and repeated, a batch that fails is aborted and, once the
    query is started again, comes again with its number."""

    class Writer(DataSourceStreamArrowWriter):
        def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
            sink = make()
            sink.open()
            try:
                for rows in batches:
                    sink.invoke(rows)
                return _Message(sink.close())
            except BaseException:
                sink.cancel()
                raise

        def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
            make().commit(batchId, [m.value for m in messages if m is not None])

        def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
            make().abort(batchId, [m.value for m in messages if m is not None])

    name = f"millrace_tasks_{uuid.uuid4().hex}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:  # noqa: N802
            return Writer()

    df.sparkSession.dataSource.register(Source)
    writer = df.writeStream.format(name).outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


class FileSink:
    """Parquet files below ``root``, a folder that the driver and all executors can reach. A task
    writes ``files/<random name>.parquet``; the commit lists a batch's files in
    ``commits/<number>.json``, and readers read what is listed. ``root`` belongs to one
    checkpoint. Files of tasks that were lost stay, unlisted.
    """

    def __init__(self, root: str) -> None:
        self.root = root

    def open(self) -> None:
        self.name, self.writer = f"files/{uuid.uuid4().hex}.parquet", None

    def invoke(self, rows: pa.RecordBatch) -> None:
        if self.writer is None:
            store, path = _place(self.root)
            store.create_dir(posixpath.join(path, "files"), recursive=True)
            self.writer = pq.ParquetWriter(posixpath.join(path, self.name), rows.schema, filesystem=store)
        self.writer.write_batch(rows)

    def close(self) -> str | None:
        """The file's name; None of a task without rows, which writes none."""
        if self.writer is None:
            return None
        self.writer.close()
        return self.name

    def cancel(self) -> None:
        if self.writer is not None:
            self.writer.close()
            self._remove([self.name])

    def commit(self, batch_id: int, messages: list) -> None:
        store, path = _place(self.root)
        folder = posixpath.join(path, "commits")
        store.create_dir(folder, recursive=True)
        draft = posixpath.join(folder, f".{uuid.uuid4().hex}")
        with store.open_output_stream(draft) as out:
            out.write(json.dumps([name for name in messages if name]).encode())
        store.move(draft, posixpath.join(folder, f"{batch_id}.json"))  # the list is there whole or not at all

    def abort(self, batch_id: int, messages: list) -> None:
        self._remove([name for name in messages if name])

    def _remove(self, names: list[str]) -> None:
        store, path = _place(self.root)
        for name in names:
            store.delete_file(posixpath.join(path, name))


def committed_files(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of the committed batches of a ``FileSink``."""
    store, path = _place(root)
    commits = store.get_file_info(fs.FileSelector(posixpath.join(path, "commits"), allow_not_found=True))
    names: list[str] = []
    for commit in commits:
        if commit.extension == "json":
            with store.open_input_stream(commit.path) as listed:
                names += json.loads(listed.read())
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{name}" for name in names])


def _place(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if ":" in root else (fs.LocalFileSystem(), root)
