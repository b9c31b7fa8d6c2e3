"""Words of Arrow text batches as arrays of 64-bit hashes.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. Texts are
never decoded: a whole batch is cut and hashed with a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Base of the rolling hash and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes hashed in one go; a longer word is taken whole.
SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_table() -> np.ndarray:
    """A value per byte, the same for both cases of an ASCII letter."""
    values = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


VALUES = byte_table()
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, SEGMENT), U64)
        have[1:] = U64(base)
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


class Texts(NamedTuple):
    """Bytes of consecutive texts and where each begins; the last offset is the end."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Hash, first byte and end of every word; ``docs[i]:docs[i + 1]`` are text i's."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    docs: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    if not len(column):
        return Texts(data[:0], np.zeros(1, np.int64))
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    offsets = texts_of(batch[column]).offsets
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def spans(texts: Texts, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between spaces, none of them across two texts."""
    data, offsets = texts
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~spaces[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last[:-1] &= ~inside[1:] | cut[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SEGMENT, "right")))
        low, high = starts[at], ends[to - 1]
        sums = np.zeros(high - low + 1, U64)
        np.cumsum(values[data[low:high]] * powers(BASE, high - low), out=sums[1:])
        begin = starts[at:to] - low
        out[at:to] = (sums[ends[at:to] - low] - sums[begin]) * powers(BASE_INVERSE, high - low)[begin]
        at = to
    return mix(out)


def words_of(texts: Texts, spaces: np.ndarray = SPACES) -> Words:
    starts, ends = spans(texts, spaces)
    return Words(hashes(texts.data, starts, ends), starts, ends, np.searchsorted(starts, texts.offsets))


def rows_of(docs: np.ndarray) -> np.ndarray:
    """For each element, which text it belongs to."""
    return np.repeat(np.arange(len(docs) - 1), np.diff(docs))


def windows(hashed: np.ndarray, docs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of ``size`` words within a text, and their offsets by text."""
    counts = np.maximum(np.diff(docs) - size + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    if len(hashed) < size:
        return np.zeros(0, U64), offsets
    rolled = np.zeros(len(hashed) - size + 1, U64)
    for k in range(size):
        rolled = rolled * U64(BASE) + hashed[k : len(hashed) - size + 1 + k]
    at = np.arange(offsets[-1]) + np.repeat(docs[:-1] - offsets[:-1], counts)
    return mix(rolled[at]), offsets


def sum_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[i]:offsets[i + 1]]``, 0 where that is empty."""
    out = np.zeros(len(offsets) - 1, values.dtype if values.dtype != bool else np.int64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        out[full] = np.add.reduceat(values.astype(out.dtype, copy=False), offsets[full])
    return out
