"""Table lifecycle as Spark SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.offsets import compact


def copy_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A new table holding the rows of ``df``; ``path`` places it in a folder."""
    writer = df.write.format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def copy_structure(spark: SparkSession, source: str, name: str) -> None:
    """An empty table with the columns of ``source``."""
    spark.sql(f"CREATE TABLE {name} LIKE {source}")


def add_columns(spark: SparkSession, name: str, columns: str) -> None:
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def recreate(spark: SparkSession, name: str, columns: str, distributed_by: str, buckets: int) -> None:
    """Drop the table if there is one and create it empty, hashed into buckets by
    ``distributed_by`` so that joins on it need no shuffle."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({distributed_by}) INTO {buckets} BUCKETS"
    )


def refill(df: DataFrame, name: str, fill: Mapping[str, Column] | None = None) -> None:
    """Replace the rows of table ``name``, which keeps its columns, types and buckets;
    ``df`` may be computed from it.

    Columns are matched by name; one that ``df`` lacks gets its value in ``fill``, or
    null. The new rows are written beside the old ones and the names are then swapped, so
    a job that dies leaves the table as it was or lets ``recover`` finish the swap. One
    writer at a time: rows appended meanwhile are lost.
    """
    spark = df.sparkSession
    recover(spark, name)
    columns = spark.table(name).columns
    unknown = sorted(set(df.columns) - set(columns))
    if unknown:
        raise ValueError(f"{name} has no column {', '.join(unknown)}")
    fresh, old = f"{name}__fresh", f"{name}__old"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    copy_structure(spark, name, fresh)
    value = {c: F.col(c) for c in df.columns}
    missing = dict(fill or {})
    df.select(*[value.get(c, missing.get(c, F.lit(None))).alias(c) for c in columns]).write.insertInto(fresh)
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.sql(f"DROP TABLE {old}")


def recover(spark: SparkSession, name: str) -> None:
    """Finish or undo a swap that was cut short; every refill begins with it."""
    old = f"{name}__old"
    if not spark.catalog.tableExists(old):
        return
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE {old}")
    else:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")


def compact_offset_table(spark: SparkSession, name: str) -> None:
    """Bring an offset history table, of one topic or several, down to one row per source
    partition, from its own rows."""
    recover(spark, name)
    history = spark.table(name)
    keys = [c for c in ("topic", "partition_value") if c in history.columns]
    refill(compact(history, keys), name, {"insert_time": F.current_timestamp()})
