"""The database sinks, with a recording connection in place of a database.

No database is started here: what is checked is which statements run, in which
transactions, and what happens on failures and replays.
"""

import re

import pytest
from pyspark.sql import functions as F

from millrace.operators.route import ROUTED_SCHEMA
from millrace.sinks.jdbc import (
    Outlet, append_per_table, append_rows, commit_per_table, commit_with_offsets, compact_offsets, rows_into_view,
    stage_rows, transaction,
)
from millrace.sinks.metrics import table_metrics_to_folder
from millrace.sources.jdbc import Database, _quoted, jdbc_query, jdbc_view

GROUPS = Outlet("group", "groups", ("id", "group_code"), "groups_topic", "group_offsets")
MEMBERS = Outlet("member", "members", ("id", "group_id"), "members_topic", "member_offsets")
DB = Database("jdbc:none:", "no.such.Driver", {"user": "u", "password": "secret"}, connections=2)


class Recorder:
    """Stands for the database: keeps what was committed."""

    def __init__(self):
        self.log, self.committed, self.fail_on = [], [], None

    def connect(self, spark=None):
        return Connection(self)


class Connection:
    def __init__(self, db):
        self.db, self.pending = db, []

    def setAutoCommit(self, flag):
        assert flag is False

    def createStatement(self):
        return self

    def executeUpdate(self, sql):
        if self.db.fail_on and self.db.fail_on in sql:
            raise RuntimeError("database gone")
        self.pending.append(sql)
        return len(self.pending)

    def executeQuery(self, sql):
        target, run, batch_id = re.search(r"target = '(.*)' AND run = '(.*)' AND batch_id = (.*)", sql).groups()
        entry = f"VALUES ('{target}', '{run}', {batch_id}, "
        return Count(sum("INTO ledger" in s and entry in s for s in self.db.committed))

    def commit(self):
        self.db.log.append(("commit", len(self.pending)))
        self.db.committed += self.pending
        self.pending = []

    def rollback(self):
        self.db.log.append(("rollback", len(self.pending)))
        self.pending = []

    def close(self):
        self.db.log.append("close")
        assert not self.pending


class Count:
    def __init__(self, n):
        self.n = n

    def next(self):
        return True

    def getLong(self, _):
        return self.n


@pytest.fixture
def db():
    return Recorder()


@pytest.fixture
def batch(spark):
    rows = [("group", 1, "g", None, "groups", 0, 5, None), ("member", 2, None, "m", "members", 1, 6, None)]
    return spark.createDataFrame(rows, ROUTED_SCHEMA)


def writer(kind, db, staged):
    return kind(
        [GROUPS, MEMBERS], "staging", "ledger",
        stage=lambda df, table: staged.append((table, df.count())), connect=db.connect,
    )


def test_all_tables_and_offsets_share_a_transaction(db, batch):
    staged = []
    writer(commit_with_offsets, db, staged)(batch, 3)
    assert staged == [("staging", 2)]
    assert [e for e in db.log if e != "close"] == [("commit", 5)]
    targets = [s.split()[2] for s in db.committed]
    assert targets == ["groups", "members", "group_offsets", "member_offsets", "ledger"]


def test_corrupt_messages_fail_the_batch_unless_they_have_an_outlet(spark, db, batch):
    odd = batch.unionByName(spark.createDataFrame(
        [("corrupt", None, None, None, "groups", 0, 9, bytearray(b"{"))], ROUTED_SCHEMA
    ))
    staged = []
    with pytest.raises(ValueError, match="no outlet for corrupt messages, such as groups at 9"):
        writer(commit_with_offsets, db, staged)(odd, 3)
    assert not staged and not db.committed
    outlets = [GROUPS, MEMBERS, Outlet("corrupt", "rejected", ("topic", "partition_value", "offset_value", "value"))]
    write = commit_with_offsets(
        outlets, "staging", "ledger", stage=lambda df, table: staged.append(df.count()), connect=db.connect
    )
    write(odd, 3)
    assert staged == [3] and any("INTO rejected" in s for s in db.committed)


def test_a_batch_is_decoded_at_its_own_width_before_connections_limit_it(spark, db, batch):
    seen = []
    wide = batch.repartition(7).withColumn("id", F.col("id") + F.spark_partition_id() * 0)

    def stage(df, table):
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen.append("Scan parquet" in plan and "Exchange" not in plan)

    commit_with_offsets([GROUPS, MEMBERS], "staging", "ledger", stage=stage, connect=db.connect)(wide, 1)
    assert seen == [True]


def test_each_table_has_its_transaction(db, batch):
    writer(commit_per_table, db, [])(batch, 3)
    assert [e for e in db.log if e != "close"] == [("commit", 2), ("commit", 2)]


def test_plain_inserts_go_to_each_table(monkeypatch, batch):
    from millrace.sinks import jdbc

    seen = []
    monkeypatch.setattr(jdbc, "append_rows", lambda df, db, table: seen.append((table, list(map(tuple, df.collect())))))
    append_per_table([GROUPS, MEMBERS], DB)(batch, 0)
    assert seen == [("groups", [(1, "g")]), ("members", [(2, "m")])]


def test_rows_and_time_of_each_table_are_kept(spark, monkeypatch, batch, tmp_path):
    from millrace.sinks import jdbc

    monkeypatch.setattr(jdbc, "append_rows", lambda df, db, table: df.write.mode("append").parquet(str(tmp_path / table)))
    write = append_per_table([GROUPS, MEMBERS], DB, table_metrics_to_folder(spark, str(tmp_path / "metrics")))
    more = batch.union(batch.where("kind = 'group'"))
    write(batch, 0)
    write(more, 1)
    kept = {(r.batch_id, r.table): r for r in spark.read.parquet(str(tmp_path / "metrics")).collect()}
    assert {k: r.rows for k, r in kept.items()} == {(0, "groups"): 1, (0, "members"): 1, (1, "groups"): 2, (1, "members"): 1}
    assert sum(r.rows for (n, _), r in kept.items() if n == 1) == more.count()
    assert all(r.millis > 0 and r.run == "none" for r in kept.values())


@pytest.mark.parametrize(("kind", "want"), [
    # the stand-in says how many statements its transaction has had
    (commit_per_table, [[("groups", 1)], [("members", 1)]]),
    (commit_with_offsets, [[("groups", 1), ("members", 2)]]),
])
def test_transactions_tell_what_the_database_counted(db, batch, kind, want):
    kept = []
    write = kind([GROUPS, MEMBERS], "staging", "ledger", stage=lambda df, table: None, connect=db.connect, keep=kept.append)
    write(batch, 4)
    write(batch, 4)  # committed already: nothing is written
    assert [[(e["table"], e["rows"]) for e in entries] for entries in kept] == want
    assert all(e["batch_id"] == 4 and e["millis"] >= 0 for entries in kept for e in entries)


def test_repeated_staging_rows_count_once(db, batch):
    writer(commit_with_offsets, db, [])(batch, 0)
    assert db.committed[0] == (
        "INSERT INTO groups (id, group_code) SELECT id, group_code FROM (SELECT DISTINCT topic, "
        "partition_value, offset_value, id, group_code FROM staging WHERE kind = 'group') staged"
    )


@pytest.mark.parametrize("fails", ["INTO groups", "INTO member_offsets", "INTO ledger"])
def test_failed_batch_is_rolled_back_raised_and_replayed(db, batch, fails):
    write = writer(commit_with_offsets, db, [])
    db.fail_on = fails
    with pytest.raises(RuntimeError):
        write(batch, 1)
    assert db.committed == [] and "commit" not in str(db.log) and "rollback" in str(db.log)
    db.fail_on = None
    write(batch, 1)
    assert len(db.committed) == 5


def test_committed_batch_is_skipped(db, batch):
    staged = []
    write = writer(commit_with_offsets, db, staged)
    write(batch, 1)
    write(batch, 1)
    assert len(staged) == 1 and len(db.committed) == 5
    write(batch, 11)
    assert len(staged) == 2 and len(db.committed) == 10


def test_batches_of_another_run_are_not_skipped(spark, db, batch):
    write, key = writer(commit_with_offsets, db, []), "sql.streaming.queryId"
    for run in ("first", "second", "second"):
        spark.sparkContext.setLocalProperty(key, run)
        write(batch, 0)
    spark.sparkContext.setLocalProperty(key, None)
    assert len(db.committed) == 10


def test_offsets_follow_the_topic(db, batch):
    writer(commit_with_offsets, db, [])(batch, 0)
    assert db.committed[3].endswith("FROM staging WHERE topic = 'members_topic' GROUP BY partition_value")


def test_only_the_missing_table_is_written_again(db, batch):
    write = writer(commit_per_table, db, [])
    db.fail_on = "INTO members"
    with pytest.raises(RuntimeError):
        write(batch, 1)
    db.fail_on = None
    write(batch, 1)
    assert [s.split()[2] for s in db.committed] == ["groups", "ledger", "members", "ledger"]


def test_compaction_reads_its_own_table(db):
    transaction(db.connect(), compact_offsets(MEMBERS, "scratch"))
    assert db.log == [("commit", 4), "close"]
    assert "FROM member_offsets GROUP BY partition_value" in db.committed[1]


def test_passwords_stay_out_of_the_text_form():
    assert "secret" not in repr(DB)


@pytest.mark.parametrize("use", [
    lambda spark, batch: jdbc_query(spark, DB, "select 1"),
    lambda spark, batch: append_rows(batch, DB, "t"),
    lambda spark, batch: stage_rows(DB)(batch, "t"),
    lambda spark, batch: jdbc_view(spark, DB, "t", "v"),
    lambda spark, batch: DB.connect(spark),
])
def test_real_sources_and_sinks_reach_for_the_driver(spark, batch, use):
    with pytest.raises(Exception, match="no.such.Driver"):
        use(spark, batch)


def test_view_options_are_quoted():
    assert _quoted("it's \\") == "it\\'s \\\\"


def test_rows_go_into_a_view_by_insert(spark, batch, tmp_path):
    (tmp_path / "v").mkdir()
    spark.sql(f"CREATE TEMPORARY VIEW sink_view (id bigint, group_code string) USING parquet OPTIONS (path '{tmp_path}/v')")
    rows_into_view("sink_view", ["id", "group_code"])(batch, 0)
    assert spark.read.parquet(f"{tmp_path}/v").count() == 2
