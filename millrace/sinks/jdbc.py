"""Batches into database tables.

Spark's JDBC writer commits once per task, and a task whose executor is lost may
write twice. So the rows of a batch go to a staging table in parallel, and short
transactions then move them to their tables inside the database: staged rows carry
their source position, by which repeated ones are dropped. A ledger row written by
the same transaction makes a replayed batch a no-op.

Tables (``Outlet`` names the first two kinds):

- result table: the outlet's columns
- offset history: ``partition_value int, offset_value bigint, insert_time timestamp``
- staging table: the columns of ``route.ROUTED_SCHEMA``

Rows of a kind without an outlet, corrupt messages say, fail the batch before anything of
it is written; give them an ``Outlet`` or filter them out.
- ledger: ``target varchar, run varchar, batch_id bigint, committed_at timestamp``
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import materialise, working
from millrace.sinks.batches import WriteBatch, run_of
from millrace.sinks.metrics import KeepTables, millis_since, timed_write
from millrace.sources.jdbc import Database

Stage = Callable[[DataFrame, str], None]
Connect = Callable[[SparkSession], Any]


@dataclass(frozen=True)
class Outlet:
    """The table that rows of one kind go to, and the offset history of a topic."""

    kind: str
    table: str
    columns: tuple[str, ...]
    topic: str | None = None
    offsets: str | None = None


def append_rows(df: DataFrame, database: Database, table: str) -> None:
    """Plain parallel insert without transactions: fast, at least once."""
    _writer(df, database, table).option("isolationLevel", "NONE").mode("append").save()


def append_per_table(outlets: Sequence[Outlet], database: Database, keep: KeepTables | None = None) -> WriteBatch:
    """A ``foreachBatch`` writer of routed rows with a plain insert per table; a
    replayed batch is inserted again. ``keep`` gets the rows and the time of each insert."""

    def write(batch: DataFrame, batch_id: int) -> None:
        entries = []
        with working(batch.sparkSession):
            rows = decoded(batch, outlets)
            for outlet in outlets:
                own = rows.where(F.col("kind") == outlet.kind).select(*outlet.columns)
                if keep is None:
                    append_rows(own, database, outlet.table)
                else:
                    count, millis = timed_write(own, lambda df, to=outlet.table: append_rows(df, database, to))
                    entries.append(_entry(batch, batch_id, outlet.table, count, millis))
        if keep is not None:
            keep(entries)

    return write


def _entry(batch: DataFrame, batch_id: int, table: str, rows: int, millis: int) -> dict:
    return {"run": run_of(batch), "batch_id": batch_id, "table": table, "rows": rows, "millis": millis}


def decoded(batch: DataFrame, outlets: Sequence[Outlet]) -> DataFrame:
    """The rows of a batch, written once at the width it is read at: the few connections
    of a database must not narrow the reading and decoding too."""
    rows = materialise(batch, "batch")
    lost = rows.where(~F.col("kind").isin([o.kind for o in outlets])).select("kind", "topic", "offset_value").first()
    if lost:
        raise ValueError(f"no outlet for {lost.kind} messages, such as {lost.topic} at {lost.offset_value}")
    return rows


def stage_rows(database: Database) -> Stage:
    """Replaces the rows of a staging table, keeping its definition."""
    return lambda df, table: _writer(df, database, table).option("truncate", "true").mode("overwrite").save()


def _writer(df: DataFrame, database: Database, table: str):
    return (
        df.write.format("jdbc").options(**database.options())
        .option("dbtable", table)
        .option("numPartitions", database.connections)
        .option("batchsize", database.batch_rows)
    )


def insert_rows(outlet: Outlet, staging: str) -> str:
    columns = ", ".join(outlet.columns)
    return (
        f"INSERT INTO {outlet.table} ({columns}) SELECT {columns} FROM "
        f"(SELECT DISTINCT topic, partition_value, offset_value, {columns} "
        f"FROM {staging} WHERE kind = '{outlet.kind}') staged"
    )


def insert_offsets(outlet: Outlet, staging: str) -> str:
    return (
        f"INSERT INTO {outlet.offsets} (partition_value, offset_value, insert_time) "
        f"SELECT partition_value, MAX(offset_value), CURRENT_TIMESTAMP "
        f"FROM {staging} WHERE topic = '{outlet.topic}' GROUP BY partition_value"
    )


def compact_offsets(outlet: Outlet, scratch: str) -> list[str]:
    """Statements bringing an offset history down to one row per partition; run them
    in one transaction."""
    return [
        f"DELETE FROM {scratch}",
        f"INSERT INTO {scratch} (partition_value, offset_value) SELECT partition_value, "
        f"MAX(offset_value) FROM {outlet.offsets} GROUP BY partition_value",
        f"DELETE FROM {outlet.offsets}",
        f"INSERT INTO {outlet.offsets} (partition_value, offset_value, insert_time) "
        f"SELECT partition_value, offset_value, CURRENT_TIMESTAMP FROM {scratch}",
    ]


def transaction(connection: Any, statements: Sequence[str]) -> list[tuple[int, int]]:
    """All statements or none; a failure is raised after the rollback. Returns the rows that
    each statement changed, as the database says, and its milliseconds."""
    done = []
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            begin = time.monotonic()
            done.append((statement.executeUpdate(sql), millis_since(begin)))
        connection.commit()
        return done
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _recorded(connection: Any, ledger: str, target: str, run: str, batch_id: int) -> bool:
    try:
        found = connection.createStatement().executeQuery(
            f"SELECT COUNT(*) FROM {ledger} "
            f"WHERE target = '{target}' AND run = '{run}' AND batch_id = {batch_id}"
        )
        found.next()
        return found.getLong(1) > 0
    finally:
        connection.close()


def _write_groups(
    groups: dict[str, list[str]], outlets: Sequence[Outlet], staging: str, ledger: str, stage: Stage,
    connect: Connect, keep: KeepTables | None,
) -> WriteBatch:
    """A batch writer running one transaction per entry of ``groups``. ``keep`` gets the rows
    and the time of the insert into each result table, after its transaction."""
    tables = {insert_rows(o, staging): o.table for o in outlets}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_of(batch)
        todo = [t for t in groups if not _recorded(connect(spark), ledger, t, run, batch_id)]
        if not todo:
            return
        with working(spark):
            stage(decoded(batch, outlets), staging)
        for target in todo:
            record = (
                f"INSERT INTO {ledger} (target, run, batch_id, committed_at) "
                f"VALUES ('{target}', '{run}', {batch_id}, CURRENT_TIMESTAMP)"
            )
            done = transaction(connect(spark), [*groups[target], record])
            if keep is not None:
                made = zip(groups[target], done, strict=False)
                keep([_entry(batch, batch_id, tables[sql], *what) for sql, what in made if sql in tables])

    return write


def commit_per_table(
    outlets: Sequence[Outlet], staging: str, ledger: str,
    database: Database | None = None, stage: Stage | None = None, connect: Connect | None = None,
    keep: KeepTables | None = None,
) -> WriteBatch:
    """A ``foreachBatch`` writer of routed rows with one transaction per table."""
    groups = {o.table: [insert_rows(o, staging)] for o in outlets}
    return _write_groups(
        groups, outlets, staging, ledger, stage or stage_rows(database), connect or database.connect, keep
    )


def commit_with_offsets(
    outlets: Sequence[Outlet], staging: str, ledger: str,
    database: Database | None = None, stage: Stage | None = None, connect: Connect | None = None,
    target: str = "all", keep: KeepTables | None = None,
) -> WriteBatch:
    """A ``foreachBatch`` writer of routed rows that commits the rows of all tables
    and the newest source offsets in a single transaction."""
    statements = [insert_rows(o, staging) for o in outlets]
    statements += [insert_offsets(o, staging) for o in outlets if o.offsets]
    return _write_groups(
        {target: statements}, outlets, staging, ledger, stage or stage_rows(database), connect or database.connect, keep
    )


def rows_into_view(view: str, columns: Sequence[str]) -> WriteBatch:
    """A ``foreachBatch`` writer inserting into a view made by ``jdbc_view``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select(*columns).write.insertInto(view)

    return write
