"""Lookup joins: every input row kept, the answer null when there is none."""

from __future__ import annotations

import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from millrace.session import materialise

Fetch = Callable[[Sequence[str]], Sequence[object]]


# Parts that the rows with a null key are spread over.
SPREAD = 1024


def lookup_join(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Left join to a lookup table; a key with several rows there gives as many.

    No broadcast hint is given: Spark broadcasts ``dim`` when its size is under the
    session's threshold and shuffles otherwise, splitting the partitions of hot keys.
    Null keys match nothing and are spread over all partitions. Each side is read once.
    """
    # by the row's own values, so that a repeated task deals out the same
    values = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    part = F.pmod(F.xxhash64(*[F.col(f"`{v}`") for v in values]), F.lit(SPREAD))
    left = df.withColumn("_spread", F.when(F.col(on).isNull(), part).otherwise(0).cast("bigint"))
    # 0 in any case, but a plain 0 would be taken for a constant and not dealt out by
    nothing = F.pmod(F.xxhash64(on), F.lit(1)).cast("bigint")
    right = dim.where(F.col(on).isNotNull()).withColumn("_spread", nothing)
    return left.join(right, [on, "_spread"], "left").drop("_spread")


def lookup_map(df: DataFrame, on: str, mapping: dict[str, str], name: str) -> DataFrame:
    """Left join to a mapping given in code.

    Made from an Arrow table the mapping is a local relation, whose size the planner
    knows when it decides on broadcasting.
    """
    rows = pa.table({on: list(mapping), name: list(mapping.values())})
    return lookup_join(df, df.sparkSession.createDataFrame(rows), on)


def service_lookup(
    df: DataFrame,
    key: str,
    name: str,
    fetch: Fetch,
    on_error: str = "null",
    tasks: int | None = None,
) -> DataFrame:
    """Add ``name``, the service's answer for ``key``, and ``<name>_error``.

    ``fetch`` takes a list of keys and returns one answer per key, in order; an
    exception object among the answers marks that key as failed. It runs on the
    executors. A failed key gets null, or ``""`` with ``on_error="empty"``.

    A table asks once per distinct key, in as many ``tasks`` as there are cores by
    default: the answers are written to the shared folder, so no later failure repeats
    a request, and joined back. A stream asks once per distinct key of each Arrow
    batch, where the rows are; ``streaming.answers`` asks once per key of the whole run.
    """
    check_lookup(df, key, on_error)
    if df.isStreaming:
        return ask_service(df, key, name, fetch, on_error)
    # keys are small, and adaptive execution would put them all into a task or two
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    keys = df.select(key).where(F.col(key).isNotNull()).distinct().repartition(tasks)
    answers = materialise(ask_service(keys, key, name, fetch, on_error), "answers")
    return lookup_join(df, answers, key)


def check_lookup(df: DataFrame, key: str, on_error: str) -> None:
    if on_error not in ("null", "empty"):
        raise ValueError("on_error is 'null' or 'empty'")
    if not isinstance(df.schema[key].dataType, T.StringType):
        raise TypeError(f"{key} must be a string column")


def ask_service(df: DataFrame, key: str, name: str, fetch: Fetch, on_error: str) -> DataFrame:
    """Ask where the rows are, once per distinct key of each Arrow batch."""
    schema = T.StructType(
        [*df.schema.fields, T.StructField(name, T.StringType()), T.StructField(f"{name}_error", T.StringType())]
    )
    failed = "" if on_error == "empty" else None

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            wanted = list(rows[key].dropna().unique())
            answers = dict(zip(wanted, fetch(wanted), strict=True))
            errors = {k: str(a) or type(a).__name__ for k, a in answers.items() if isinstance(a, Exception)}
            values = {k: failed if k in errors else a for k, a in answers.items()}
            rows[name] = rows[key].map(values).astype(object)
            rows[f"{name}_error"] = rows[key].map(errors).astype(object)
            yield rows

    return df.mapInPandas(ask, schema)


def retrying(fetch: Fetch, attempts: int = 3, wait: float = 0.5, longest: float = 30.0) -> Fetch:
    """``fetch`` asking again for the keys that failed, after ``wait`` seconds and then twice
    as long each time, up to ``longest``. What still fails after ``attempts`` stays failed.

    The waits are in the task that asks. A ``fetch`` that raises counts as failed for all its
    keys, so that its last error is an answer and not the end of the job.
    """

    def ask(keys: Sequence[str]) -> Sequence[object]:
        answers: dict[str, object] = {}
        todo = list(keys)
        for attempt in range(attempts):
            if attempt:
                time.sleep(min(wait * 2 ** (attempt - 1), longest))
            try:
                got = fetch(todo)
            except Exception as error:
                got = [error] * len(todo)
            answers.update(zip(todo, got, strict=True))
            todo = [k for k in todo if isinstance(answers[k], Exception)]
            if not todo:
                break
        return [answers[k] for k in keys]

    return ask


def http_fetch(
    url: str, param: str, method: str = "GET", timeout: float = 10.0, concurrency: int = 8
) -> Fetch:
    """A ``fetch`` asking a web service for each key.

    GET sends ``param=key`` in the address, POST in the body; keys are encoded. The
    answer is the response without its line breaks.
    """

    def one(key: str) -> object:
        query = urllib.parse.urlencode({param: key})
        try:
            if method == "POST":
                request = urllib.request.Request(url, data=query.encode())
            else:
                request = urllib.request.Request(f"{url}?{query}")
            with urllib.request.urlopen(request, timeout=timeout) as response:
                return "".join(response.read().decode().splitlines())
        except Exception as error:
            return error

    def fetch(keys: Sequence[str]) -> Sequence[object]:
        with ThreadPoolExecutor(concurrency) as pool:
            return list(pool.map(one, keys))

    return fetch
