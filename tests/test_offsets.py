"""Source positions, and tables in the session's catalogue."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.operators.offsets import EARLIEST, compact, merge, newest, next_offsets, starting_offsets
from millrace.operators.tables import (
    add_columns, compact_offset_table, copy_structure, copy_table, recover, recreate, refill,
)

# stored_offsets of the fixtures
STORED = [("groups", 2, 10210912), ("groups", 0, 186171), ("groups", 1, 20210912)]
COLUMNS = "topic string, partition_value int, offset_value bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_reading_goes_on_after_the_stored_offsets(spark):
    history = frame(spark, STORED + [("groups", 0, 5)])
    assert rows(next_offsets(history)) == [
        ("groups", 0, 186172), ("groups", 1, 20210913), ("groups", 2, 10210913),
    ]


def test_starting_offsets_option(spark):
    history = frame(spark, STORED[:2] + [("members", 0, 8)])
    assert json.loads(starting_offsets(history, {"groups": [0, 1, 2]})) == {
        "groups": {"0": 186172, "1": EARLIEST, "2": 10210913}
    }
    assert json.loads(starting_offsets(history, {"members": [0], "groups": [2]})) == {
        "members": {"0": 9}, "groups": {"2": 10210913}
    }
    assert starting_offsets(history, {"other": [0]}) == "earliest"
    assert starting_offsets(frame(spark, []), {"groups": [0]}) == "earliest"


def test_merge_keeps_the_larger(spark):
    batch = frame(spark, [("groups", 0, 7), ("groups", 1, 30210912), ("groups", 3, 1)])
    assert rows(merge(frame(spark, STORED), batch)) == [
        ("groups", 0, 186171), ("groups", 1, 30210912), ("groups", 2, 10210912), ("groups", 3, 1),
    ]


def test_newest_per_batch_and_compaction(spark):
    df = frame(spark, STORED + STORED[:1]).withColumn("b", F.lit(1))
    assert newest(df, "b").count() == 3
    assert rows(compact(df)) == sorted(STORED)


@pytest.fixture
def history(spark):
    for t in ("history", "history__old", "history__fresh", "copied", "shaped"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    return copy_table(frame(spark, STORED + [("groups", 0, 3), ("members", 0, 1)]), "history")


def test_offset_table_is_compacted_from_itself(spark, history):
    compact_offset_table(spark, "history")
    assert rows(spark.table("history")) == sorted(STORED + [("members", 0, 1)])
    compact_offset_table(spark, "history")
    assert spark.table("history").count() == 4
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("history")] == ["history"]


def test_a_failed_refill_leaves_the_table(spark, history):
    broken = spark.table("history").withColumn("offset_value", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception):
        refill(broken, "history")
    assert spark.table("history").count() == 5
    refill(compact(spark.table("history")), "history")
    assert spark.table("history").count() == 4


def test_a_refilled_table_keeps_its_columns_and_buckets(spark, history):
    spark.sql("DROP TABLE IF EXISTS kept")
    recreate(spark, "kept", "partition_value int, offset_value bigint, insert_time timestamp", "partition_value", 4)
    spark.sql("INSERT INTO kept VALUES (0, 5, timestamp '2024-01-01'), (0, 7, timestamp '2024-01-02'), (1, 3, timestamp '2024-01-01')")
    compact_offset_table(spark, "kept")
    table = spark.table("kept")
    assert rows(table.drop("insert_time")) == [(0, 7), (1, 3)] and table.where("insert_time is null").isEmpty()
    assert table.columns == ["partition_value", "offset_value", "insert_time"]
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED kept").collect()}
    assert described["Num Buckets"] == "4" and "partition_value" in described["Bucket Columns"]
    spark.sql("INSERT INTO kept VALUES (2, 1, timestamp '2024-01-03')")
    assert spark.table("kept").count() == 3
    with pytest.raises(ValueError, match="no column other"):
        refill(table.withColumn("other", F.lit(1)), "kept")


def test_a_swap_cut_short_is_made_up(spark, history):
    spark.sql("ALTER TABLE history RENAME TO history__old")
    recover(spark, "history")
    assert spark.table("history").count() == 5
    spark.sql("CREATE TABLE history__old LIKE history")
    spark.sql("CREATE TABLE history__fresh LIKE history")
    compact_offset_table(spark, "history")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("history")] == ["history"]
    assert spark.table("history").count() == 4


def test_table_copies(spark, history, tmp_path):
    copied = copy_table(history, "copied", str(tmp_path / "copied"))
    assert rows(copied) == rows(history)
    copy_structure(spark, "history", "shaped")
    assert spark.table("shaped").dtypes == history.dtypes and spark.table("shaped").isEmpty()
    add_columns(spark, "shaped", "insert_time timestamp")
    assert spark.table("shaped").columns[-1] == "insert_time"


def test_tables_hashed_by_a_key_join_without_a_shuffle(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("bucketed_a", "bucketed_b"):
        recreate(session, name, "id bigint, v string", "id", 4)
        recreate(session, name, "id bigint, v string", "id", 4)
        session.range(100).select("id", F.lit(name)).write.insertInto(name)
    joined = session.table("bucketed_a").join(session.table("bucketed_b"), "id")
    assert joined.count() == 100
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
