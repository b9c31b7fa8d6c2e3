"""Streams over text files, one file per batch: results equal those on tables."""

import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F, types as T

from millrace.functions.text import csv_key_ts, tokens
from millrace.operators.aggregate import keyed_totals
from millrace.operators.offsets import newest, starting_offsets
from millrace.operators.route import ROUTED_SCHEMA, route
from millrace.operators.running import running_totals
from millrace.operators.watermark import flag_late
from millrace.operators.windows import collect_window, tumbling
from millrace.plans.catalogue import in_batches
from millrace.plans.jobs import (
    look_up_clients, messages_to_tables, name_events, project_view, window_report, word_count,
)
from millrace.session import ROCKSDB_PROVIDER, child_names, materialise, remove_older, shared_dir, streaming_session, working
from millrace.sinks.console import printed
from millrace.sinks.metrics import BatchMetrics, batch_metrics
from millrace.sinks.tables import commit_to_folder, committed_batches, committed_rows, compact_folder, stored_offsets
from millrace.sources.kafka import KAFKA_SCHEMA, message_text
from millrace.sources.text import folder_lines, socket_lines
from millrace.sources.views import json_view
from millrace.streaming.event_time import with_bounded_lateness
from millrace.streaming.lists import closed_rows, lists_to_folder
from millrace.streaming.run import start_batches, start_files
from millrace.streaming.totals import changelog_to_folder, latest_totals, totals_before, updates_to_folder, with_bucket
from millrace.streaming.watermark import late_to_folder, trace_to_folder

BASE = 1790820681000


def write_files(folder, files):
    """Text files with rising modification times, so they arrive in order."""
    os.makedirs(folder, exist_ok=True)
    known = len(os.listdir(folder))
    for i, lines in enumerate(files, start=known):
        path = f"{folder}/f{i:03d}.txt"
        with open(path, "w") as f:
            f.writelines(line + "\n" for line in lines)
        os.utime(path, (1_700_000_000 + i * 10,) * 2)


def key_times(*events):
    return [f"{k},{BASE + ms}" for k, ms in events]


def test_socket_and_folder_have_the_same_columns(spark, tmp_path):
    write_files(tmp_path / "in", [["a"]])
    socket = socket_lines(spark, "localhost", 9)
    assert socket.isStreaming and socket.dtypes == [("value", "string")]
    assert folder_lines(spark, str(tmp_path / "in")).dtypes == socket.dtypes


def test_state_is_kept_in_rocksdb(spark):
    session = streaming_session(spark)
    assert session.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB_PROVIDER


def run(df, folder, write, mode="append"):
    query = start_batches(df, write, f"{folder}/checkpoint", mode=mode)
    query.awaitTermination()
    return query


def test_word_count_over_batches(spark, tmp_path):
    write_files(tmp_path / "in", [["a b", "a  "], ["b b", ""], ["c a"]])
    totals = word_count(folder_lines(spark, str(tmp_path / "in"), 1))
    run(totals, tmp_path, updates_to_folder(f"{tmp_path}/out"), mode="update")
    updates = spark.read.parquet(f"{tmp_path}/out")
    got = latest_totals(updates, ["word"], "cnt")
    want = keyed_totals(tokens(spark.read.text(str(tmp_path / "in")), "value"), ["word"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert updates.select("batch_id").distinct().count() == 3


def test_changelog_over_batches_and_restarts(spark, tmp_path):
    def lines():
        parts = F.split("value", ",")
        return folder_lines(spark, str(tmp_path / "in"), 1).select(
            F.nullif(parts[0], F.lit("~")).alias("k"), parts[1].cast("int").alias("seq")
        )

    # a key may be null, and some keys come back after many batches
    rows = [("hot" if i % 3 else None if i % 7 == 0 else f"k{i % 7}", i) for i in range(240)]
    text = [f"{k},{i}" if k else f"~,{i}" for k, i in rows]
    write = changelog_to_folder(f"{tmp_path}/out", ["k"], ["seq"], "n", rows_per_range=20, buckets=3)
    cuts = [0, 100, 101, 103, 110, 111, 200, 240]
    files = [text[a:b] for a, b in zip(cuts, cuts[1:])]
    write_files(tmp_path / "in", files[:4])
    run(lines(), tmp_path, write)
    write_files(tmp_path / "in", files[4:])
    run(lines(), tmp_path, write)
    # a batch written again changes nothing
    write(spark.createDataFrame(rows[200:], "k string, seq int"), 6)
    got = spark.read.parquet(f"{tmp_path}/out/changes")
    assert got.select("batch_id").distinct().count() == 7
    want = running_totals(spark.createDataFrame(rows, "k string, seq int"), ["k"], ["seq"], "n")
    assert sorted(map(str, got.select("k", "seq", "n").collect())) == sorted(map(str, want.collect()))
    # what all buckets have merged is gone
    assert sorted(os.listdir(tmp_path / "out" / "new"))[:2] == ["batch_id=3", "batch_id=4"]
    assert all(len(os.listdir(tmp_path / "out" / "merged" / b)) <= 2 for b in os.listdir(tmp_path / "out" / "merged"))


def test_a_batch_reads_the_buckets_it_has_keys_in(spark, tmp_path):
    root = f"{tmp_path}/out"
    write = changelog_to_folder(root, ["k"], ["seq"], "n", buckets=4)
    rows = [(f"k{i % 40}", i) for i in range(400)]
    for n in range(10):
        write(spark.createDataFrame(rows[n * 40 : n * 40 + 40], "k string, seq int").coalesce(1), n)
    one = with_bucket(spark.createDataFrame([("k7",)], "k string"), ["k"], 4).first()["_bucket"]
    schema = T.StructType.fromDDL("k string, n bigint")
    before = totals_before(spark, root, schema, 10, [one], 4)
    paths = [r[0] for r in before.select(F.input_file_name()).distinct().collect()]
    assert paths and all(f"_bucket={one}/" in p for p in paths)
    plan = before._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*_bucket#\d+ = ", plan)) == 2
    assert {r.k: r.n for r in latest_totals(before, ["k"], "n").collect()}["k7"] == 10


def test_empty_batches_leave_totals_as_they_are(spark, tmp_path):
    write = changelog_to_folder(f"{tmp_path}/out", ["k"], ["seq"], "n", "v", buckets=2)
    schema = "k string, seq int, v int"
    for n, rows in enumerate([[], [("a", 1, 5)], [], [], [("a", 2, 6), ("b", 3, 1)]]):
        write(spark.createDataFrame(rows, schema), n)
    got = spark.read.schema("k string, seq int, n bigint").parquet(f"{tmp_path}/out/changes")
    assert sorted((r.k, r.n) for r in got.collect()) == [("a", 5), ("a", 11), ("b", 1)]


def test_the_working_folder_does_not_grow_with_the_batches(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 1000), ("b", 2, 5000)], "k string, seq int, ms int")
    rows = rows.withColumn("ts", F.timestamp_millis("ms")).coalesce(1)
    writers = [
        changelog_to_folder(f"{tmp_path}/totals", ["k"], ["seq"], "n", rows_per_range=1),
        trace_to_folder(f"{tmp_path}/trace", "ts", "1 SECOND", ["k"], ["seq"], rows_per_range=1),
        late_to_folder(f"{tmp_path}/late", "ts", "1 second", "1 SECOND", ["k"], ["seq"], rows_per_range=1),
        lists_to_folder(f"{tmp_path}/lists", ["seq"], rows_per_range=1),
    ]
    lists = rows.select("seq", F.col("ts").alias("ws"), F.col("k").alias("_item"))
    before = child_names(spark, f"{shared_dir(spark)}/millrace")
    for n in range(50):
        writers[n % 4](lists if n % 4 == 3 else rows, n // 4)
    assert child_names(spark, f"{shared_dir(spark)}/millrace") == before


def test_a_returned_table_outlives_the_work_on_it(spark):
    def counted():
        with working(spark):
            rows = materialise(spark.range(10), "inner")
            return materialise(rows.where("id > 3"), "result", keep=True)

    with working(spark):
        with working(spark):
            found = counted()
            assert found.count() == 6 and found.join(found, "id").count() == 6
        with pytest.raises(Exception, match="PATH_NOT_FOUND|FileNotFound|does not exist|FILE_NOT_EXIST"):
            found.count()
    kept = counted()
    assert kept.count() == 6 and remove_older(spark, 1) == 0 and kept.count() == 6


@pytest.mark.parametrize("salts", [1, 5])
def test_lists_of_a_window_are_given_when_it_closes(spark, tmp_path, salts):
    session = streaming_session(spark)
    rows = [(f"k{i % 2}", i, (i * 37) % 100 * 100) for i in range(100)] + [("k0", 100, None), ("k0", 101, 12_999), ("k0", 102, 500), ("k1", 103, 30_000)]
    df = session.createDataFrame(rows, "k string, seq int, ms long").withColumn("ts", F.timestamp_millis(F.col("ms") + BASE))
    late = ("k0", 102)
    for k in range(4):
        part = df.where(f"seq between {k * 26} and {k * 26 + 25}")
        if k == 3:  # a row for a window that closed by then comes in a batch of its own
            part.where("seq < 101").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            part.where("seq = 101").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            part = part.where("seq > 101")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run_on():
        stream = session.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        closed = closed_rows(with_bounded_lateness(stream, "ts", 10), "ts", "3 seconds", "seq", ["ts", "seq"], ["k"], salts)
        start_batches(closed, lists_to_folder(f"{tmp_path}/out", ["ts", "seq"], ["k"], chunk_rows=4), f"{tmp_path}/checkpoint").awaitTermination()

    run_on()
    more = session.createDataFrame([("k1", 200, 60_000)], "k string, seq int, ms long").withColumn("ts", F.timestamp_millis(F.col("ms") + BASE))
    more.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run_on()
    on_time = df.unionByName(more).where(f"seq <> {late[1]} and ms < 49000")
    want = collect_window(on_time, "ts", "3 seconds", "seq", ["ts", "seq"], ["k"], chunk_rows=4).where("ws is not null")
    got = session.read.parquet(f"{tmp_path}/out").drop("batch_id").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_windows_of_the_clock_close_when_it_is_past_them(spark, tmp_path):
    session = streaming_session(spark)
    df = session.createDataFrame([(i,) for i in range(20)], "seq int")
    df.where("seq < 10").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = session.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    closed = closed_rows(stream, None, "2 seconds", "seq", ["seq"])
    query = start_batches(closed, lists_to_folder(f"{tmp_path}/out", ["seq"]), f"{tmp_path}/checkpoint", every="500 milliseconds")
    until, lists = time.time() + 90, []
    try:
        while time.time() < until and not any(p.numInputRows for p in query.recentProgress):
            time.sleep(0.2)
        time.sleep(2.5)
        df.where("seq >= 10").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        while time.time() < until:
            time.sleep(1)
            if not os.path.isdir(f"{tmp_path}/out"):
                continue
            lists = session.read.schema("ws timestamp, chunk long, cnt long, items array<int>").parquet(f"{tmp_path}/out").collect()
            if sum(r.cnt for r in lists) == 20:
                break
    finally:
        query.stop()
    assert sorted(x for r in lists for x in r["items"]) == list(range(20))
    assert len({r.ws for r in lists}) == 2 and sorted(r["items"][0] for r in lists) == [0, 10]


def closed_windows(spark, tmp_path, files, exact):
    write_files(tmp_path / "in", files)
    events = folder_lines(spark, str(tmp_path / "in"), 1).select(*csv_key_ts("value"))
    windows = tumbling(with_bounded_lateness(events, "ts", 10, exact), "ts", "3 seconds", ["k"])
    start_files(windows, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    rows = spark.read.schema(windows.schema).parquet(f"{tmp_path}/out")
    return sorted(tuple(r) for r in rows.select("k", "cnt", F.unix_millis("ws") - BASE).collect())


def test_window_closes_at_its_last_millisecond(spark, tmp_path):
    files = [key_times(("a", 0), ("a", 2999)), key_times(("b", 12999))]
    assert closed_windows(spark, tmp_path / "exact", files, True) == [("a", 2, 0)]
    assert closed_windows(spark, tmp_path / "later", files, False) == []


def test_rows_far_behind_the_watermark_are_dropped(spark, tmp_path):
    files = [
        key_times(("a", 0), ("a", 2999)), key_times(("b", 60000)), key_times(("c", 61000)),
        key_times(("a", 1000), ("d", 52000)), key_times(("d", 120000)),
    ]
    got = closed_windows(spark, tmp_path, files, True)
    # the late row of a is gone; the one of d, out of order but in bounds, counts
    assert got == [("a", 2, 0), ("b", 1, 60000), ("c", 1, 60000), ("d", 1, 51000)]


def test_window_report_is_the_same_on_streams_and_tables(spark, tmp_path):
    session = streaming_session(spark)
    session.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    lines = ["0001,1790820682000"]
    write_files(tmp_path / "in", [lines, ["x,1790820699999"]])
    report = window_report(folder_lines(session, str(tmp_path / "in"), 1))
    start_files(report, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    want = "0001,1,2026-10-01 10:11:222026-10-01 10:11:222026-10-01 10:11:212026-10-01 10:11:24"
    assert [r.line for r in session.read.parquet(f"{tmp_path}/out").collect()] == [want]
    table = session.createDataFrame([(x,) for x in lines], "value string")
    assert [r.line for r in window_report(table).collect()] == [want]


def test_named_events_stream(spark, tmp_path):
    write_files(tmp_path / "in", [["{event_id: '1001', n: 1}", "{event_id: '7', n: 2}"]])
    named = name_events(folder_lines(spark, str(tmp_path / "in")), {"1001": "1001name"})
    run(named, tmp_path, lambda b, i: b.write.mode("append").text(f"{tmp_path}/out"))
    got = spark.read.text(f"{tmp_path}/out").select(F.from_json("value", "map<string,string>")).collect()
    assert sorted((r[0] for r in got), key=str) == [
        {"event_id": "1001", "n": "1", "event_name": "1001name"}, {"event_id": "7", "n": "2"},
    ]


def test_an_event_that_is_not_json_fails_the_job(spark):
    lines = spark.createDataFrame([("not json",)], "value string")
    with pytest.raises(Exception, match="MALFORMED"):
        name_events(lines, {"1001": "1001name"}).collect()


def test_clients_are_looked_up_on_the_stream(spark, tmp_path):
    write_files(tmp_path / "in", [["ines,device-31", "omar,bad"]])

    def fetch(keys):
        return [KeyError("unknown") if k == "bad" else "answer-of-31" for k in keys]

    clients = look_up_clients(folder_lines(spark, str(tmp_path / "in")), fetch)
    run(clients, tmp_path, lambda b, i: b.write.mode("append").parquet(f"{tmp_path}/out"))
    got = spark.read.parquet(f"{tmp_path}/out").select("name", "client_id", "xuid", "xuid_error").collect()
    assert sorted(map(tuple, got)) == [
        ("ines", "device-31", "answer-of-31", None), ("omar", "bad", None, "'unknown'"),
    ]


# --- messages ------------------------------------------------------------------


def message_stream(spark, tmp_path, per_batch=1):
    """A stream of messages in Kafka's columns, from lines of JSON."""
    schema = "value string, topic string, partition int, offset bigint"
    lines = folder_lines(spark, str(tmp_path / "in"), per_batch)
    return lines.select(F.from_json("value", schema).alias("m")).select(
        F.lit(None).cast("binary").alias("key"), F.col("m.value").cast("binary").alias("value"),
        "m.topic", "m.partition", "m.offset",
        F.timestamp_seconds(F.lit(0)).alias("timestamp"), F.lit(0).alias("timestampType"),
    )


def envelope(spark, rows):
    df = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint")
    return [r[0] for r in df.select(F.to_json(F.struct("*"))).collect()]


GROUPS = [(f'{{"id":{i},"group_code":"g{i}"}}', "groups", i % 2, i // 2) for i in range(10)]
MEMBERS = [(f"{{id: {i}, group_id: 'm{i}'}}", "members", 0, i) for i in range(6)]
ODD = [("not json", "members", 0, 6), ('{"id":"77","group_code":null}', "groups", 1, 5)]


def test_message_stream_has_kafka_columns(spark, tmp_path):
    write_files(tmp_path / "in", [["{}"]])
    from pyspark.sql import types as T

    got = message_stream(spark, tmp_path)
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in T.StructType.fromDDL(KAFKA_SCHEMA)
    ]
    assert message_text(got).dtypes == [("value", "string")]


def test_messages_are_committed_with_their_offsets(spark, tmp_path):
    files = [GROUPS[:6] + MEMBERS[:1], GROUPS[6:] + MEMBERS[1:] + ODD]
    write_files(tmp_path / "in", [envelope(spark, f) for f in files])
    root = f"{tmp_path}/out"
    listener = BatchMetrics()
    spark.streams.addListener(listener)
    query = messages_to_tables(
        message_stream(spark, tmp_path), commit_to_folder(root), f"{tmp_path}/checkpoint", None
    )
    query.awaitTermination()
    got = committed_rows(spark, root)
    assert got.where("kind = 'corrupt'").first().value is not None and got.where("kind <> 'corrupt' and value is not null").isEmpty()
    counts = {r.kind: r["count"] for r in got.groupBy("kind").count().collect()}
    assert counts == {"group": 11, "member": 6, "corrupt": 1}
    odd = got.where("topic = 'groups' and offset_value = 5").first()
    assert (odd.kind, odd.id, odd.group_code) == ("group", 77, None)
    offsets = stored_offsets(spark, root).select("batch_id", "topic", "partition_value", "offset_value")
    assert sorted(map(tuple, offsets.collect())) == [
        (0, "groups", 0, 2), (0, "groups", 1, 2), (0, "members", 0, 0),
        (1, "groups", 0, 4), (1, "groups", 1, 5), (1, "members", 0, 6),
    ]
    metrics = batch_metrics(query)
    assert [(m["batch_id"], m["rows"], m["all"], m["group"], m["member"], m["corrupt"]) for m in metrics] == [
        (0, 7, 7, 6, 1, 0), (1, 11, 11, 5, 5, 1),
    ]
    assert all(m["millis"] >= 0 for m in metrics)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(listener)
    heard = [m for m in listener.entries if m["query"] == str(query.id) and m["rows"]]
    assert [m["batch_id"] for m in heard] == [0, 1] and [m["all"] for m in heard] == [7, 11]


def test_a_folder_history_is_compacted(spark, tmp_path):
    write_files(tmp_path / "in", [envelope(spark, [m]) for m in GROUPS[:6]])
    root = f"{tmp_path}/out"
    messages_to_tables(
        message_stream(spark, tmp_path), commit_to_folder(root), f"{tmp_path}/checkpoint", None
    ).awaitTermination()
    before = sorted(map(str, newest(stored_offsets(spark, root)).collect()))
    batches = len(list((tmp_path / "out" / "offsets").glob("run=*/batch_id=*")))
    removed = compact_folder(spark, root, keep=2)
    assert removed == batches - 2 > 0 and compact_folder(spark, root, keep=2) == 0
    assert sorted(map(str, newest(stored_offsets(spark, root)).collect())) == before
    assert committed_rows(spark, root).count() == 6
    # a snapshot that was not written to its end does not count
    (tmp_path / "out" / "history" / "snapshot=99").mkdir()
    assert sorted(map(str, newest(stored_offsets(spark, root)).collect())) == before


def test_the_ledger_does_not_grow_with_the_batches(spark, tmp_path):
    root = f"{tmp_path}/out"
    offsets = spark.range(100).selectExpr("id AS batch_id", "explode(array(0, 1, 2)) AS partition_value").selectExpr(
        "'t' AS topic", "partition_value", "batch_id * 10 AS offset_value", "current_timestamp() AS insert_time",
        "if(batch_id < 60, 'a', 'b') AS run", "if(batch_id < 60, batch_id, batch_id - 60) AS batch_id",
    )
    offsets.coalesce(1).write.partitionBy("run", "batch_id").parquet(f"{root}/offsets")
    rows = spark.createDataFrame([], T.StructType.fromDDL(ROUTED_SCHEMA)).schema
    found = spark.range(0, 106, 7).selectExpr("'group' AS kind", "'t' AS topic", "if(id < 60, 'a', 'b') AS run", "if(id < 60, id, id - 60) AS batch_id")
    for field in rows:
        if field.name not in found.columns:
            found = found.withColumn(field.name, F.lit(None).cast(field.dataType))
    found.coalesce(1).write.partitionBy("run", "batch_id", "kind").parquet(f"{root}/rows")
    known, before = committed_rows(spark, root).count(), sorted(map(str, newest(stored_offsets(spark, root)).collect()))
    assert known == len(range(0, 100, 7))  # the last batch was not committed
    assert compact_folder(spark, root, keep=3) == 57 + 37
    ledger = spark.read.parquet(f"{root}/history/snapshot=0")
    assert ledger.count() == 6
    assert {(r.run, r.first_batch, r.last_batch) for r in committed_batches(spark, root).collect()} == {("a", 0, 59), ("b", 0, 39)}
    assert committed_rows(spark, root).count() == known
    assert sorted(map(str, newest(stored_offsets(spark, root)).collect())) == before
    assert compact_folder(spark, root, keep=3) == 0 and os.listdir(f"{root}/history") == ["snapshot=1"]


def test_late_rows_on_a_stream_are_those_of_the_table(spark, tmp_path):
    rows = [(i, i % 2, 1000 * ((i * 37) % 200)) for i in range(200)]
    df = spark.createDataFrame(rows, "seq int, p int, ms long").withColumn("ts", F.timestamp_millis("ms"))
    for k in range(4):
        df.where(f"seq div 50 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    args = dict(ts="ts", width="3 seconds", delay="10 SECONDS", source=["p"], order=["seq"])
    write = late_to_folder(str(tmp_path / "out"), **args)
    start_batches(stream, write, str(tmp_path / "checkpoint")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "rows"))
    want = flag_late(df, **args)
    assert {r.seq: r.is_late for r in got.collect()} == {r.seq: r.is_late for r in want.collect()}
    with pytest.raises(ValueError, match="batch by batch"):
        flag_late(stream, **args)


def test_no_delay_at_all(spark, tmp_path):
    df = spark.createDataFrame([(1, 0)], "k int, ms long").select("k", F.timestamp_millis("ms").alias("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = with_bounded_lateness(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "ts", 0)
    assert stream.isStreaming


def test_batches_without_rows_leave_nothing_to_see(spark, tmp_path):
    write_files(tmp_path / "in", [envelope(spark, GROUPS), envelope(spark, MEMBERS)])
    root = f"{tmp_path}/out"
    members_only = message_stream(spark, tmp_path).where("topic = 'members'")
    messages_to_tables(members_only, commit_to_folder(root), f"{tmp_path}/checkpoint", None).awaitTermination()
    assert committed_rows(spark, root).count() == len(MEMBERS)
    assert [r.batch_id for r in stored_offsets(spark, root).collect()] == [1]


def test_nothing_is_committed_before_the_first_batch(spark, tmp_path):
    assert committed_rows(spark, str(tmp_path)).isEmpty()
    assert starting_offsets(stored_offsets(spark, str(tmp_path)), {"groups": [0]}) == "earliest"


def test_a_new_checkpoint_goes_on_from_the_stored_offsets(spark, tmp_path):
    root = f"{tmp_path}/out"

    def start(messages, checkpoint):
        messages_to_tables(messages, commit_to_folder(root), f"{tmp_path}/{checkpoint}", None).awaitTermination()

    write_files(tmp_path / "in", [envelope(spark, MEMBERS[:4])])
    start(message_stream(spark, tmp_path), "first")
    option = starting_offsets(stored_offsets(spark, root), {"members": [0, 1]})
    first = json.loads(option)["members"]
    assert first == {"0": 4, "1": -2}
    # the topic is replayed from the offset in the option, under a new checkpoint
    write_files(tmp_path / "in", [envelope(spark, MEMBERS[4:])])
    start(message_stream(spark, tmp_path, 10).where(F.col("offset") >= first["0"]), "second")
    got = committed_rows(spark, root)
    assert sorted(r.id for r in got.collect()) == list(range(6))
    assert got.select("run").distinct().count() == 2
    assert {r.batch_id for r in got.collect()} == {0}


class Crash(Exception):
    pass


@pytest.mark.parametrize("moment", ["before rows", "before offsets", "after commit"])
def test_a_crash_neither_loses_nor_repeats_rows(spark, tmp_path, monkeypatch, moment):
    from millrace.sinks import tables

    write_files(tmp_path / "in", [envelope(spark, f) for f in (GROUPS, MEMBERS)])
    root, commit = f"{tmp_path}/out", commit_to_folder(f"{tmp_path}/out")
    replace = tables._replace
    failing = {"on": True}

    def broken_replace(df, path, *partitions):
        if failing["on"] and "batch_id=1" in path:
            if moment == "before rows" or (moment == "before offsets" and "/offsets/" in path):
                raise Crash
        replace(df, path, *partitions)

    def broken_commit(batch, batch_id):
        commit(batch, batch_id)
        if failing["on"] and batch_id == 1:
            raise Crash

    monkeypatch.setattr(tables, "_replace", broken_replace)

    def start():
        write = broken_commit if moment == "after commit" else commit
        messages_to_tables(
            message_stream(spark, tmp_path), write, f"{tmp_path}/checkpoint", None
        ).awaitTermination()

    with pytest.raises(Exception):
        start()
    visible = committed_rows(spark, root).count()
    assert visible == (16 if moment == "after commit" else 10)
    failing["on"] = False
    start()
    got = committed_rows(spark, root).select("kind", "id").collect()
    assert sorted(map(tuple, got)) == sorted(
        [("group", i) for i in range(10)] + [("member", i) for i in range(6)]
    )


def test_sql_projection_of_a_stream(spark, tmp_path):
    rows = GROUPS[:3] + [("not json", "groups", 0, 9), ('{"id":"x","group_code":"g"}', "groups", 0, 10)]
    write_files(tmp_path / "in", [envelope(spark, rows)])
    json_view(message_stream(spark, tmp_path), "stream_groups", "id bigint, group_code string")
    projected = project_view(spark, "stream_groups", ["id", "group_code"])
    start_files(projected, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(0, "g0"), (1, "g1"), (2, "g2"), (None, "g")], key=str
    )


def test_raw_text_keeps_quotes(spark, tmp_path):
    df = spark.createDataFrame(GROUPS[:1], "value string, topic string, partition int, offset bigint")
    assert route(df, raw=True).first().group_code == '"g0"'
    assert route(df).first().group_code == "g0"


def test_printing(spark, tmp_path, capsys):
    write_files(tmp_path / "in", [["hello"]])
    query = printed(folder_lines(spark, str(tmp_path / "in"))).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress.numInputRows == 1
    assert capsys.readouterr().out == "batch 0: value\nhello\n"


def test_batches_do_not_grow_with_the_files_of_a_table(spark, tmp_path):
    """A part of a table is a batch, whatever number of files it has."""
    df = spark.range(4000).select("id", (F.col("id") % 7).alias("k"))
    df.repartition(12).write.parquet(f"{tmp_path}/in/numbers.parquet")
    seen = []

    def start(stream):
        def write(batch, batch_id):
            seen.append((batch_id, sorted(r.id for r in batch.collect())))

        return start_batches(stream, write, f"{tmp_path}/checkpoint")

    in_batches(spark, f"{tmp_path}/in", {"numbers": "id"}, start)
    assert seen == [(i, list(range(1000 * i, 1000 * (i + 1)))) for i in range(4)]
