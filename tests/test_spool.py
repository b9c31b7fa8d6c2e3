"""Lines that come only once, spooled: a stream over them can be run again."""

import io
import os
import threading
import time

import pytest

from millrace.sources.spool import LineSpool, spool_lines
from millrace.sources.text import folder_lines
from millrace.streaming.run import start_batches


def lines(n, start=0):
    return [f"line {i}" for i in range(start, start + n)]


def reader(values):
    return io.BytesIO("\n".join(values).encode())  # the last line has no end


def test_a_batch_that_fails_gets_the_same_lines_again(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "spool"), str(tmp_path / "checkpoint")
    assert spool_lines(reader(lines(250)), folder, lines_per_file=100) == 250
    seen = []

    def write(batch, number):
        rows = sorted(r.value for r in batch.collect())
        seen.append((number, rows))
        if len(seen) == 2:
            raise RuntimeError("died here")

    def run():
        start_batches(folder_lines(spark, folder, files_per_batch=1), write, checkpoint).awaitTermination()

    with pytest.raises(Exception, match="died here"):
        run()
    assert spool_lines(reader(lines(30, 250)), folder) == 30  # more arrives before the restart
    run()
    assert [number for number, _ in seen] == [0, 1, 1, 2, 3]
    assert seen[1] == seen[2]
    del seen[1]
    assert sorted(row for _, rows in seen for row in rows) == sorted(lines(280))


def test_lines_show_while_the_reader_is_open(tmp_path):
    folder = str(tmp_path / "spool")
    out, into = os.pipe()
    with os.fdopen(out, "rb") as read, os.fdopen(into, "wb", buffering=0) as write:
        running = threading.Thread(target=spool_lines, args=(read, folder), kwargs={"seconds": 0.05})
        running.start()
        write.write(b"first\nsecond\n")
        path = f"{folder}/lines-{0:012d}.txt"
        until = time.monotonic() + 20
        while not os.path.exists(path) and time.monotonic() < until:
            time.sleep(0.02)
        assert open(path, "rb").read().startswith(b"first\n")
        write.close()
        running.join(20)
    assert b"".join(open(f"{folder}/{n}", "rb").read() for n in sorted(os.listdir(folder))) == b"first\nsecond\n"


def test_a_reader_that_breaks_keeps_what_it_gave(tmp_path):
    def broken():
        yield b"one\n"
        yield b"\n"
        raise OSError("gone")

    with pytest.raises(OSError, match="gone"):
        spool_lines(broken(), str(tmp_path))
    assert open(f"{tmp_path}/lines-{0:012d}.txt", "rb").read() == b"one\n\n"


def test_no_lines_make_no_file(tmp_path):
    assert spool_lines(io.BytesIO(b""), str(tmp_path / "spool")) == 0
    spool = LineSpool(str(tmp_path / "spool"))
    spool.flush()
    assert os.listdir(tmp_path / "spool") == [] and spool.number == 0
