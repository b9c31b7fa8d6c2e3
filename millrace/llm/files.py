"""Arrays kept as plain files in the shared folder and memory-mapped by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
from pyarrow import fs


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def save(path: str, array: np.ndarray) -> None:
    save_bytes(path, np.ascontiguousarray(array).data)


def save_bytes(path: str, data) -> None:
    """Write under a fresh name, then move it into place, so that a repeated
    task leaves the same whole file."""
    system, name = _open(path)
    system.create_dir(os.path.dirname(name), recursive=True)
    fresh = f"{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(fresh) as out:
        out.write(data)
    system.move(fresh, name)


def mapped(path: str, dtype: str, length: int) -> np.ndarray:
    """The array in a file, memory-mapped. A file of a remote store is first copied to a
    nameless local one, which is gone when the worker lets go of it."""
    if not length:
        return np.zeros(0, dtype)
    system, name = _open(path)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(name, dtype, "r", shape=(length,))
    with tempfile.TemporaryFile() as local, system.open_input_stream(name) as remote:
        while block := remote.read(8 << 20):
            local.write(block)
        local.flush()
        return np.memmap(local, dtype, "r", shape=(length,))
