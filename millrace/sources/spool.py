"""Lines of a reader that gives them only once, kept as files that a stream reads again."""

from __future__ import annotations

import posixpath
import threading
import uuid
from collections.abc import Iterable

from pyarrow import fs


class LineSpool:
    """Lines in numbered text files of a folder that all executors can reach. A file is there
    whole or not at all and is never changed, so ``folder_lines`` of the folder gives a
    repeated batch the same lines. Numbers go on after those of files that are there; a folder
    has one spool at a time."""

    def __init__(self, folder: str, lines_per_file: int = 100_000) -> None:
        self.store, self.path = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
        self.store.create_dir(self.path, recursive=True)
        names = [info.base_name for info in self.store.get_file_info(fs.FileSelector(self.path))]
        self.number = max((int(n[6:-4]) for n in names if n.startswith("lines-") and n.endswith(".txt")), default=-1) + 1
        self.lines_per_file, self.lines = lines_per_file, 0
        self._held: list[bytes] = []
        self._lock = threading.Lock()

    def add(self, line: bytes) -> None:
        with self._lock:
            self._held.append(line.removesuffix(b"\n") + b"\n")
            self.lines += 1
            if len(self._held) >= self.lines_per_file:
                self._write()

    def flush(self) -> None:
        """Give out the lines held; no file without lines."""
        with self._lock:
            if self._held:
                self._write()

    def _write(self) -> None:
        draft = posixpath.join(self.path, f".{uuid.uuid4().hex}")  # Spark passes over such names
        with self.store.open_output_stream(draft) as out:
            out.write(b"".join(self._held))
        self.store.move(draft, posixpath.join(self.path, f"lines-{self.number:012d}.txt"))
        self._held, self.number = [], self.number + 1


def spool_lines(reader: Iterable[bytes], folder: str, lines_per_file: int = 100_000, seconds: float = 1.0) -> int:
    """Spool a reader, such as ``socket.create_connection(address).makefile("rb")``, to its
    end, and say how many lines it had. What was read shows after so many lines or seconds;
    if this process dies, lines of the last seconds that were not written are lost, as the
    reader can't give them again. Runs beside the query that reads ``folder``."""
    spool, ended = LineSpool(folder, lines_per_file), threading.Event()

    def tick() -> None:
        while not ended.wait(seconds):
            spool.flush()

    clock = threading.Thread(target=tick, daemon=True)
    clock.start()
    try:
        for line in reader:
            spool.add(line)
    finally:
        ended.set()
        clock.join()
        spool.flush()
    return spool.lines
