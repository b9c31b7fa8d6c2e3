"""Databases over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Where a database is and how much load to put on it."""

    url: str
    driver: str
    properties: dict[str, str] = field(default_factory=dict, repr=False)
    connections: int = 8
    batch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, **self.properties}

    def connect(self, spark: SparkSession) -> Any:
        """A connection of the driver program, for short transactions."""
        jvm = spark._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.properties.items():
            properties.setProperty(key, value)
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        connection = loader.loadClass(self.driver).newInstance().connect(self.url, properties)
        if connection is None:
            raise ValueError(f"{self.driver} does not accept {self.url}")
        return connection


def jdbc_query(spark: SparkSession, database: Database, query: str) -> DataFrame:
    """The rows of a SQL query that the database runs, read by one task: for results that
    are small. ``jdbc_table`` reads large ones."""
    return spark.read.format("jdbc").options(**database.options()).option("query", query).load()


def jdbc_table(
    spark: SparkSession, database: Database, table: str, column: str, low: str, high: str, parts: int
) -> DataFrame:
    """The rows of a table, or of a query in brackets with a name, in ``parts`` reads.

    ``column``, a number or time, is cut evenly between ``low`` and ``high``; rows beyond
    these, and with null, are read too.
    """
    bounds = {"dbtable": table, "partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": str(parts)}
    return spark.read.format("jdbc").options(**database.options(), **bounds).load()


def jdbc_view(spark: SparkSession, database: Database, table: str, view: str) -> None:
    """A view of a database table that can be read from and inserted into in SQL."""
    options = {**database.options(), "dbtable": table, "batchsize": str(database.batch_rows)}
    pairs = ", ".join(f"`{k}` '{_quoted(v)}'" for k, v in options.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} USING jdbc OPTIONS ({pairs})")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
