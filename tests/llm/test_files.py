import numpy as np
from pyarrow import fs

from millrace.llm import files
from millrace.llm.shipping import shipped


def test_arrays_round_trip(tmp_path):
    array = np.arange(10_000, dtype=np.uint64)
    for path in (f"{tmp_path}/a/b", f"file://{tmp_path}/c/d"):
        files.save(path, array)
        found = files.mapped(path, "uint64", len(array))
        assert isinstance(found, np.memmap) and (found == array).all()
    assert len(files.mapped(f"{tmp_path}/none", "uint64", 0)) == 0
    assert sorted(p.name for p in tmp_path.rglob("*") if p.is_file()) == ["b", "d"]


def test_arrays_of_a_remote_store_are_mapped_from_a_copy(tmp_path, monkeypatch):
    remote = fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem())
    monkeypatch.setattr(files, "_open", lambda path: (remote, path.removeprefix("far://")))
    array = np.linspace(0, 1, 300_000)
    files.save("far://x/y", array)
    found = files.mapped("far://x/y", "float64", len(array))
    assert isinstance(found, np.memmap) and (found == array).all()


def test_a_session_is_readied_once(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "77")
    assert shipped(session).conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "77"
    other = shipped(spark.newSession())
    assert other.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1000"
