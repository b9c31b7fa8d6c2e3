"""Texts as compressed values, for the shuffles that carry them.

Spark compresses a shuffle in blocks of 32 KB with a fast codec; a text compressed as a whole
with a better one is about two thirds of that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CODEC = "zstd"


def packed(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` with ``packed`` and ``size``, its bytes, in place of the column
    ``text``, which must not be null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec(CODEC)
        for batch in batches:
            raw = [value.as_buffer() for value in batch["text"].cast(pa.large_binary())]
            values = [codec.compress(data, asbytes=True) if data.size else b"" for data in raw]
            kept = {name: batch[name] for name in batch.schema.names if name != "text"}
            yield pa.record_batch(
                kept | {"packed": pa.array(values, pa.binary()), "size": pa.array([data.size for data in raw], pa.int64())}
            )

    others = [field for field in texts.schema.fields if field.name != "text"]
    return texts.mapInArrow(run, T.StructType([*others, T.StructField("packed", T.BinaryType()), T.StructField("size", T.LongType())]))


def unpacked(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows with their ``text`` again, whole rows of about ``limit`` bytes at a time, one row
    at least."""
    codec = pa.Codec(CODEC)
    offsets = np.concatenate([[0], np.cumsum(batch["size"].to_numpy())])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        rows = batch.slice(at, to - at)
        texts = [
            codec.decompress(value.as_buffer(), size, asbytes=True) if size else b""
            for value, size in zip(rows["packed"], rows["size"].to_pylist(), strict=True)
        ]
        kept = {name: rows[name] for name in rows.schema.names if name not in ("packed", "size")}
        yield pa.record_batch(kept | {"text": pa.array(texts, pa.large_binary()).cast(pa.large_string())})
        at = to
