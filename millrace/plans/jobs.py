"""The pipelines a user runs, from source frame to result.

The sources are passed in, so a pipeline runs on a socket, a topic, a folder or a
table alike. Those ending in a sink return the running query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.messages import decode_once, json_object, json_text, put_field
from millrace.functions.text import csv_key_ts, csv_pair, tokens
from millrace.operators.aggregate import keyed_totals
from millrace.operators.enrich import Fetch, lookup_map, service_lookup
from millrace.operators.offsets import starting_offsets
from millrace.operators.route import route, union_streams
from millrace.operators.windows import report_line, tumbling
from millrace.sinks.batches import WriteBatch
from millrace.sinks.metrics import observe_kinds
from millrace.sources.kafka import kafka_messages
from millrace.streaming.event_time import with_bounded_lateness
from millrace.streaming.run import start_batches


def word_count(lines: DataFrame) -> DataFrame:
    """Occurrences per word of lines of text."""
    return keyed_totals(tokens(lines, "value"), ["word"], value="n")


def name_events(messages: DataFrame, names: dict[str, str]) -> DataFrame:
    """JSON events (column ``value``) with ``event_name`` looked up by ``event_id``;
    an unknown id adds nothing. A record that is not JSON fails the job."""
    decoded = decode_once(messages, json_object("value", strict=True), "fields")
    keyed = decoded.withColumn("event_id", F.col("fields")["event_id"].cast("string"))
    named = lookup_map(keyed, "event_id", names, "event_name")
    return named.select(json_text(put_field(F.col("fields"), "event_name", F.col("event_name"))).alias("value"))


def window_report(lines: DataFrame, width: str = "3 seconds", lateness: int = 10) -> DataFrame:
    """One report line per key and event-time window of ``key,epochMillis`` lines."""
    events = lines.select(*csv_key_ts("value"))
    if lines.isStreaming:
        events = with_bounded_lateness(events, "ts", lateness)
    return report_line(tumbling(events, "ts", width, ["k"]), "k")


def look_up_clients(lines: DataFrame, fetch: Fetch) -> DataFrame:
    """``name,clientId`` lines with the service's id for each client."""
    return service_lookup(lines.select(*csv_pair("value")), "client_id", "xuid", fetch)


def messages_to_tables(
    messages: DataFrame, write: WriteBatch, checkpoint: str, every: str | None = "30 seconds"
) -> StreamingQuery:
    """Route messages by kind and write each interval's rows as one batch.

    ``write`` is a batch writer of ``sinks.jdbc`` or ``sinks.tables``.
    """
    return start_batches(observe_kinds(route(messages)), write, checkpoint, every)


def resuming_messages(
    spark: SparkSession, servers: str, stored: DataFrame, partitions: dict[str, list[int]],
    **options,
) -> DataFrame:
    """Several topics as one stream, each starting after its last committed offset."""
    return union_streams(*[
        kafka_messages(spark, servers, topic, starting_offsets(stored, {topic: ids}), **options)
        for topic, ids in partitions.items()
    ])


def project_view(spark: SparkSession, view: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a view made by ``sources.views.json_view``."""
    return spark.sql(f"SELECT {', '.join(columns)} FROM {view}")
