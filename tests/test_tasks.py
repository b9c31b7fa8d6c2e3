"""Sinks with a life per task: rows exactly once, whatever dies."""

import os

import pytest

from millrace.streaming.tasks import FileSink, committed_files, start_sink

SCHEMA = "value string"


def dying(root, step):
    """A sink that dies once at some step; its class is sent to the tasks with it."""

    class Dying(FileSink):
        def _die(self, at):
            mark = f"{self.root}-died"
            if at == step and not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("died here")

        def invoke(self, rows):
            super().invoke(rows)
            self._die("after rows")

        def close(self):
            name = super().close()
            self._die("after closing")
            return name

        def commit(self, batch_id, messages):
            self._die("before commit")
            super().commit(batch_id, messages)
            self._die("after commit")

    return Dying(root)


def lines_in(folder, *names):
    os.makedirs(folder, exist_ok=True)
    for i, name in enumerate(names):
        with open(f"{folder}/{name}", "w") as f:
            f.writelines(f"{name}-{j}\n" for j in range(50))
        os.utime(f"{folder}/{name}", (1_700_000_000 + i * 10,) * 2)


@pytest.mark.parametrize("step", [None, "after rows", "after closing", "before commit", "after commit"])
def test_rows_come_exactly_once(spark, tmp_path, step):
    lines_in(tmp_path / "in", "a", "b", "c")
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
        sink = dying(root, step)
        start_sink(lines.repartition(2), lambda: sink, checkpoint).awaitTermination()

    if step:
        with pytest.raises(Exception, match="died here"):
            run()
    run()
    got = sorted(r.value for r in committed_files(spark, root, SCHEMA).collect())
    assert got == sorted(f"{name}-{j}" for name in "abc" for j in range(50))
    assert sorted(os.listdir(f"{root}/commits")) == ["0.json", "1.json", "2.json"]


def test_without_commits_there_are_no_rows(spark, tmp_path):
    assert committed_files(spark, str(tmp_path / "none"), SCHEMA).count() == 0
