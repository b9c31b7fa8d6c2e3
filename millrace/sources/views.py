"""Message topics as SQL views, and functions for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.messages import typed_rows


def json_view(messages: DataFrame, name: str, schema: str, lenient: bool = True) -> None:
    """A temporary view of the JSON values of ``messages``, static or streaming, with
    the columns of ``schema``."""
    text = messages.select(F.col("value").cast("string").alias("value"))
    typed_rows(text, "value", schema, lenient=lenient).createOrReplaceTempView(name)


def tokens_function(spark: SparkSession, name: str = "tokens") -> None:
    """A temporary table function for SQL, ``tokens(text)``: the rows of ``functions.text.tokens``,
    a token of each line with the count 1. Used as ``FROM lines, LATERAL tokens(text)``. Its body
    is a single generator over its argument, which Spark puts over the caller's rows; of a body in
    several steps it would make a join by the text, with both sides shuffled.

    Lines of spaces only are taken out, each with the line break before it, then the spaces at
    the ends of lines; a line break is put before the first line, whose empty token is cut off."""
    spark.sql(rf"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE (word STRING, n BIGINT)
        RETURN SELECT word, 1L FROM explode(CAST(slice(split(regexp_replace(regexp_replace(concat(char(10), text),
          r'\n +(?=\n|\z)', ''), r'(?<! ) +(?=\n|\z)', ''), r'[ \n]'), 2, 2147483647) AS ARRAY<STRING>)) AS t(word)""")
