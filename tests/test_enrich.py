"""Lookups in tables, mappings and services."""

import io
import urllib.parse

import pytest
from pyspark.sql import functions as F

from millrace.operators import enrich
from millrace.operators.enrich import http_fetch, lookup_join, lookup_map, retrying, service_lookup
from millrace.session import child_names
from millrace.streaming.answers import answers_to_folder


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def facts(spark):
    return spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("seq"),
    )


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_lookup_join_keeps_every_row_once(spark, threshold):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    df = session.createDataFrame(facts(spark).collect(), "k long, seq long")
    dim = session.range(0, 500).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    plain = lookup_join(df, dim, "k").select("seq", "k", "name")
    want = sorted(
        ((s, k, str(k) if k is not None and k < 500 else None) for k, s in df.collect()), key=str
    )
    assert rows(plain) == want


def test_repeated_keys_of_the_lookup_table_give_as_many_rows(spark):
    dim = spark.createDataFrame([(7, "a"), (7, "b"), (None, "n")], "k long, name string")
    df = spark.createDataFrame([(7,), (8,), (None,)], "k long")
    assert rows(lookup_join(df, dim, "k")) == sorted([(7, "a"), (7, "b"), (8, None), (None, None)], key=str)


def test_a_lookup_runs_no_job_and_reads_each_side_once(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.range(0, 4000).select((F.when(F.col("id") % 10 == 0, F.col("id"))).alias("k"), F.col("id").alias("n")).write.parquet(str(tmp_path / "a"))
    session.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("name")).write.parquet(str(tmp_path / "b"))
    left, right = (session.read.parquet(str(tmp_path / n)) for n in "ab")
    session.sparkContext.setJobGroup("lookup", "")
    joined = lookup_join(left, right, "k")
    assert not session.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    # nine rows of ten have no key, and yet no task gets most of them
    session.conf.set("spark.sql.adaptive.enabled", "false")
    sizes = lookup_join(left, right, "k").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(sizes) == 4 and sizes.max() < 2000


def test_mapping_is_broadcast_and_misses_are_null(spark):
    df = spark.createDataFrame([("1001",), ("7",), (None,)], "event_id string")
    named = lookup_map(df, "event_id", {"1001": "1001name"}, "event_name")
    assert rows(named) == sorted([("1001", "1001name"), ("7", None), (None, None)], key=str)
    assert "BroadcastHashJoin" in named._jdf.queryExecution().executedPlan().toString()


def clients(spark):
    keys = ["a", "a", "b", "bad", None] + ["hot"] * 40
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, client string").repartition(4)


def test_service_is_asked_once_per_key(spark, tmp_path):
    log = str(tmp_path / "asked")

    def fetch(keys):
        with open(log, "a") as f:
            f.writelines(f"{k}\n" for k in keys)
        return [ValueError("no") if k == "bad" else f"x{k}" for k in keys]

    got = service_lookup(clients(spark), "client", "xuid", fetch)
    answers = {r.i: (r.xuid, r.xuid_error) for r in got.collect()}
    assert answers[0] == answers[1] == ("xa", None)
    assert answers[3] == (None, "no") and answers[4] == (None, None)
    assert [answers[i] for i in range(5, 45)] == [("xhot", None)] * 40
    got.count()
    with open(log) as f:
        assert sorted(f.read().split()) == ["a", "b", "bad", "hot"]


def test_requests_are_spread_over_tasks(spark):
    def fetch(keys):
        from pyspark import TaskContext

        return [str(TaskContext.get().partitionId())] * len(keys)

    df = spark.range(200).select(F.col("id").cast("string").alias("k"))
    assert service_lookup(df, "k", "task", fetch, tasks=5).select("task").distinct().count() == 5


def test_failed_keys_can_be_empty(spark):
    got = service_lookup(clients(spark), "client", "xuid", lambda keys: [OSError("x")] * len(keys), "empty")
    assert {(r.client, r.xuid) for r in got.collect()} == {
        ("a", ""), ("b", ""), ("bad", ""), ("hot", ""), (None, None)
    }


def test_service_needs_one_answer_per_key(spark):
    with pytest.raises(Exception, match="zip"):
        service_lookup(clients(spark), "client", "xuid", lambda keys: keys[:-1]).collect()


def test_service_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        service_lookup(clients(spark), "client", "x", list, "other")
    with pytest.raises(TypeError):
        service_lookup(clients(spark), "i", "x", list)


@pytest.mark.parametrize("method", ["GET", "POST"])
def test_web_requests(monkeypatch, method):
    asked = []

    def urlopen(request, timeout):
        asked.append((request.full_url, request.data, request.get_method()))
        if "missing" in (request.full_url + str(request.data)):
            raise OSError("gone")
        return io.BytesIO(b"one\ntwo\n")

    monkeypatch.setattr(enrich.urllib.request, "urlopen", urlopen)
    fetch = http_fetch("http://service/xuid", "clientid", method, concurrency=1)
    good, bad = fetch(["a b&c", "missing"])
    assert good == "onetwo" and isinstance(bad, OSError)
    query = urllib.parse.urlencode({"clientid": "a b&c"})
    assert asked[0] == (
        (f"http://service/xuid?{query}", None, "GET") if method == "GET"
        else ("http://service/xuid", query.encode(), "POST")
    )


def test_failed_keys_are_asked_again(monkeypatch):
    calls, waits = [], []
    monkeypatch.setattr(enrich.time, "sleep", waits.append)

    def fetch(keys):
        calls.append(list(keys))
        if len(calls) == 1:
            raise OSError("down")
        return [OSError(k) if k == "bad" or (k == "slow" and len(calls) < 3) else k.upper() for k in keys]

    a, slow, bad = retrying(fetch, attempts=4, wait=1, longest=3)(["a", "slow", "bad"])
    assert (a, slow) == ("A", "SLOW") and isinstance(bad, OSError)
    assert calls == [["a", "slow", "bad"], ["a", "slow", "bad"], ["slow", "bad"], ["bad"]]
    assert waits == [1, 2, 3]


def test_a_run_asks_once_per_key(spark, tmp_path):
    log, root, now = str(tmp_path / "asked"), str(tmp_path / "out"), [1000.0]

    def fetch(keys):
        with open(log, "a") as f:
            f.writelines(f"{k}\n" for k in keys)
        return [ValueError("no") if k == "bad" else f"x{k}" for k in keys]

    def asked():
        with open(log, "a+") as f:
            f.seek(0)
            found = f.read().split()
            f.truncate(0)
        return sorted(found)

    write = answers_to_folder(root, "k", "x", fetch, keep=100, keep_failed=10, buckets=2, clock=lambda: now[0])

    def batch(number, *keys):
        df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string").repartition(3)
        write(df, number)
        rows = spark.read.parquet(f"{root}/rows/batch_id={number}").collect()
        assert [k for _, k in sorted((r.i, r.k) for r in rows)] == list(keys)
        assert {(r.x, r.x_error) for r in rows if r.k is None} <= {(None, None)}
        assert all(r.x == (None if r.k == "bad" else f"x{r.k}") for r in rows if r.k is not None)
        assert {r.x_error for r in rows if r.k == "bad"} <= {"no"}
        return asked()

    assert batch(0, "a", "a", "bad", None, "b") == ["a", "b", "bad"]
    assert batch(1, "b", "c", "bad", "a") == ["c"]
    assert batch(1, "b", "c", "bad", "a") == []  # a batch that comes again
    assert batch(2, None) == []
    now[0] += 20  # failures are forgotten sooner
    assert batch(3, "a", "b", "bad", "c") == ["bad"]
    for number in range(4, 10):
        assert batch(number, "a", "d") == (["d"] if number == 4 else [])
    # what has been merged is gone, and the store does not grow with the batches
    assert len(child_names(spark, f"{root}/new")) <= 4
    assert sum(len(child_names(spark, f"{root}/merged/{b}")) for b in child_names(spark, f"{root}/merged")) <= 4
    now[0] += 100
    assert batch(10, "a", "c", "d") == ["a", "c", "d"]


def test_answers_of_rows_without_keys_and_of_no_rows(spark, tmp_path):
    write = answers_to_folder(str(tmp_path), "k", "x", lambda keys: [OSError("e")] * len(keys), on_error="empty")
    write(spark.createDataFrame([], "k string, other int"), 0)
    write(spark.createDataFrame([(None, 1), ("q", 2)], "k string, other int"), 1)
    got = spark.read.parquet(f"{tmp_path}/rows")
    assert rows(got.select("other", "x", "x_error")) == sorted([(1, None, None), (2, "", "e")], key=str)
