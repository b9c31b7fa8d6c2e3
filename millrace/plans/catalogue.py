"""Checked queries: each runs on the given tables and, where SQL can say it, comes
with the SQL that gives the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.messages import (
    as_long, json_field, json_object, json_text, put_field, raw_text, typed_rows,
)
from millrace.functions.text import csv_key_ts, csv_pair, tokens
from millrace.functions.times import epoch_micros, format_time, utc_clock
from millrace.operators.aggregate import keyed_totals, windowed_totals
from millrace.operators.enrich import lookup_join, lookup_map, service_lookup
from millrace.operators.offsets import compact, merge, newest, next_offsets
from millrace.operators.route import groups, members, route, union_streams
from millrace.operators.running import running_totals
from millrace.operators.tables import add_columns, compact_offset_table, copy_table, recreate, refill
from millrace.operators.watermark import drop_late, flag_late, trace
from millrace.operators.watermarks import min_trace
from millrace.operators.windows import (
    assign_window, collect_window, over_windows, report_line, tumbling, window_counts,
)
from millrace.plans.jobs import messages_to_tables, project_view
from millrace.session import new_path, streaming_session
from millrace.sinks.tables import commit_to_folder, committed_rows, compact_folder, stored_offsets
from millrace.sources.kafka import as_messages
from millrace.sources.views import json_view, tokens_function
from millrace.streaming.answers import answers_to_folder
from millrace.streaming.event_time import with_bounded_lateness
from millrace.streaming.lists import closed_rows, lists_to_folder
from millrace.streaming.run import start_batches, start_files
from millrace.streaming.totals import changelog_to_folder, latest_totals, updates_to_folder
from millrace.streaming.watermark import trace_to_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = oracle
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- lines, words and running totals -------------------------------------------

_TOKENS = """
  select {keep} unnest(case when length(l) > 0 and rtrim(l, ' ') = '' then []
                            else string_split(rtrim(l, ' '), ' ') end) as word
  from (select {keep} unnest(string_split(text, chr(10))) as l from documents)"""


@query(f"select word, count(*) as cnt from ({_TOKENS.format(keep='')}) group by word")
def q_word_count(spark: SparkSession, sf: str) -> DataFrame:
    return keyed_totals(tokens(table(spark, sf, "documents"), "text"), ["word"], value="n")


@query(f"select doc_id, word, cast(1 as bigint) as n from ({_TOKENS.format(keep='doc_id,')})")
def q_tokenize(spark: SparkSession, sf: str) -> DataFrame:
    return tokens(table(spark, sf, "documents"), "text", "doc_id")


@query(ORACLES["q_tokenize"])
def q_sql_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """A function from a row to rows, used in SQL over a view."""
    table(spark, sf, "documents").createOrReplaceTempView("token_source")
    tokens_function(spark)
    return spark.sql("SELECT doc_id, word, n FROM token_source, LATERAL tokens(text)")


_RUNNING_COUNT = """
select event_id, event_type, count(*) over (
  partition by event_type order by event_id
  rows between unbounded preceding and current row) as running_cnt
from events"""


@query(_RUNNING_COUNT)
def q_running_count(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    return running_totals(events, ["event_type"], ["event_id"], "running_cnt")


# Rows to a range of the queries that show how hot keys are cut.
FEW_ROWS = 500


@query(_RUNNING_COUNT)
def q_running_count_ranged(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    return running_totals(events, ["event_type"], ["event_id"], "running_cnt", rows_per_range=FEW_ROWS)


@query("""
select c_custkey, sum(c_nationkey) over (
  partition by c_mktsegment order by c_name rows between unbounded preceding and current row)::bigint as reached
from customer""")
def q_running_by_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name", F.col("c_nationkey").cast("bigint").alias("n"))
    got = running_totals(rows, ["c_mktsegment"], ["c_name"], "reached", "n", rows_per_range=FEW_ROWS)
    return got.select("c_custkey", "reached")


@query("""
select o_orderkey, count(*) over (
  order by o_orderstatus, o_orderpriority, o_orderkey rows between unbounded preceding and current row) as place
from orders""")
def q_running_three_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Many ties in the first two columns of the order."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    order = ["o_orderstatus", "o_orderpriority", "o_orderkey"]
    return running_totals(rows, [], order, "place", rows_per_range=FEW_ROWS).select("o_orderkey", "place")


@query("""
select event_type as k, count(*) as cnt, time_bucket(interval 2 second, ts) as ws,
       time_bucket(interval 2 second, ts) + interval 2 second as we
from events group by all""")
def q_windowed_totals(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumnRenamed("event_type", "k")
    return windowed_totals(events, "ts", "2 seconds", ["k"])


# --- windows and watermarks ----------------------------------------------------

_TUMBLING = """
select user_id as k, count(*) as cnt, min(ts) as min_ts, max(ts) as max_ts,
       time_bucket(interval 1 hour, ts) as ws,
       time_bucket(interval 1 hour, ts) + interval 1 hour as we
from events group by all"""


@query(_TUMBLING)
def q_tumbling_event_time(spark: SparkSession, sf: str) -> DataFrame:
    return tumbling(table(spark, sf, "events").withColumnRenamed("user_id", "k"), "ts", "1 hour", ["k"])


_LINE = """
select concat(k, ',', cnt, ',', {times}) as line from ({windows})"""


@query(_LINE.format(
    windows=_TUMBLING,
    times=", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S')" for c in ("min_ts", "max_ts", "ws", "we")),
))
def q_window_report_line(spark: SparkSession, sf: str) -> DataFrame:
    return report_line(q_tumbling_event_time(spark, sf), "k")


@query("""
select event_id, max(ts) over w as max_ts, max(ts) over w - interval 10 seconds as wm
from events window w as (partition by user_id % 8 order by event_id
                         rows between unbounded preceding and current row)""")
def q_watermark_trace(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", (F.col("user_id") % 8).alias("sp"))
    return trace(events, "ts", "10 SECONDS", ["sp"], ["event_id"]).select("event_id", "max_ts", "wm")


# Events are stored in time order. Arrival is put out of order by a delay of up to
# two hours that depends on the id.
_ARRIVALS = """
with o as (select event_id, user_id, epoch_us(ts) as us, user_id % 8 as sp,
                  epoch_us(ts) + ((event_id * 7919) % 7200) * 1000000 as arr from events),
w as (select *, max(us) over (partition by sp order by arr, event_id
                              rows between unbounded preceding and 1 preceding) as seen,
             (us // 3600000000 + 1) * 3600000000 as we from o),
f as (select event_id, user_id, we, coalesce(we - 1000 <= seen - 600000000, false) as is_late from w)
"""


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "user_id", "ts", (F.col("user_id") % 8).alias("sp"),
        (epoch_micros("ts") + F.col("event_id") * 7919 % 7200 * 1_000_000).alias("arr"),
    )


_LATENESS = {"ts": "ts", "width": "1 hour", "delay": "10 MINUTES", "source": ["sp"], "order": ["arr", "event_id"]}


@query(f"{_ARRIVALS} select event_id, is_late from f")
def q_late_flag(spark: SparkSession, sf: str) -> DataFrame:
    return flag_late(_arrivals(spark, sf), **_LATENESS).select("event_id", "is_late")


@query(f"{_ARRIVALS} select event_id, is_late from f")
def q_late_flag_ranged(spark: SparkSession, sf: str) -> DataFrame:
    return flag_late(_arrivals(spark, sf), **_LATENESS, rows_per_range=FEW_ROWS).select("event_id", "is_late")


@query(f"""{_ARRIVALS}
select user_id as k, count(*) as cnt, make_timestamp(we - 3600000000) as ws
from f where not is_late group by user_id, we""")
def q_late_dropped_agg(spark: SparkSession, sf: str) -> DataFrame:
    kept = drop_late(_arrivals(spark, sf), **_LATENESS)
    return kept.groupBy(F.col("user_id").alias("k"), "ws").agg(F.count(F.lit(1)).alias("cnt"))


_REACHED = ", ".join(f"max(us) filter (where sp = {i}) over w" for i in range(8))


@query(f"""{_ARRIVALS},
m as (select event_id, we, list_value({_REACHED}) as reached,
             (select count(distinct sp) from o) as sources
      from w window w as (order by arr, event_id rows between unbounded preceding and 1 preceding)),
l as (select event_id, we, case when list_count(reached) = sources then list_min(reached) end as low from m)
select event_id, make_timestamp(low - 600000000) as wm, coalesce(we - 1000 <= low - 600000000, false) as is_late from l""")
def q_watermark_min(spark: SparkSession, sf: str) -> DataFrame:
    """The watermark of all sources that a row meets, and whether it had closed the row's window."""
    rows = min_trace(
        assign_window(_arrivals(spark, sf), "ts", "1 hour"), "ts", "10 MINUTES", "sp", ["arr", "event_id"],
        include_current=False, rows_per_range=FEW_ROWS,
    )
    last = F.col("ws") + F.expr("INTERVAL 1 HOUR") - F.expr("INTERVAL 1 MILLISECOND")
    return rows.select("event_id", "wm", F.coalesce(last <= F.col("wm"), F.lit(False)).alias("is_late"))


@query("select event_id, time_bucket(interval 30 second, ts) as ws from events")
def q_window_assign(spark: SparkSession, sf: str) -> DataFrame:
    return assign_window(table(spark, sf, "events"), "ts", "30 seconds").select("event_id", "ws")


@query("""
select event_id, case when event_id % 7 > 0 then time_bucket(interval 30 second, ts) end as ws from events""")
def q_window_assign_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a time keep their place, without a window."""
    ts = F.when(F.col("event_id") % 7 > 0, F.col("ts"))
    events = table(spark, sf, "events").select("event_id", ts.alias("ts"))
    return assign_window(events, "ts", "30 seconds").select("event_id", "ws")


@query("select time_bucket(interval 30 second, ts) as ws, count(*) as cnt from events group by 1")
def q_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    return window_counts(table(spark, sf, "events"), "ts", "30 seconds")


@query("""
select ws, chunk, count(*) as cnt, string_agg(cast(event_id as varchar), ',' order by n) as ids
from (select *, (n - 1) // 10000 as chunk from (
  select event_id, time_bucket(interval 30 second, ts) as ws,
         row_number() over (partition by time_bucket(interval 30 second, ts) order by ts, event_id) as n
  from events)) group by ws, chunk""")
def q_window_collect(spark: SparkSession, sf: str) -> DataFrame:
    lists = collect_window(
        table(spark, sf, "events"), "ts", "30 seconds", F.col("event_id").cast("string"),
        ["ts", "event_id"], name="ids",
    )
    return lists.withColumn("ids", F.array_join("ids", ","))


@query("""
select ws, chunk, count(*) as cnt, string_agg(cast(event_id as varchar), ',' order by n) as ids
from (select *, (n - 1) // 25 as chunk from (
  select event_id, time_bucket(interval 1 day, ts) as ws,
         row_number() over (partition by time_bucket(interval 1 day, ts) order by ts, event_id) as n
  from events)) group by ws, chunk""")
def q_window_collect_chunked(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of many rows, each as several lists."""
    lists = collect_window(
        table(spark, sf, "events"), "ts", "1 day", F.col("event_id").cast("string"), ["ts", "event_id"], name="ids",
        chunk_rows=25, rows_per_range=FEW_ROWS,
    )
    return lists.withColumn("ids", F.array_join("ids", ","))


@query("""
select k, ws, chunk, string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S'), ',' order by n) as times
from (select *, (n - 1) // 10000 as chunk from (
  select user_id as k, ts, time_bucket(interval 1 hour, ts) as ws,
         row_number() over (partition by user_id, time_bucket(interval 1 hour, ts) order by ts, event_id) as n
  from events)) group by k, ws, chunk""")
def q_window_sorted_list(spark: SparkSession, sf: str) -> DataFrame:
    lists = collect_window(
        table(spark, sf, "events").withColumnRenamed("user_id", "k"), "ts", "1 hour",
        format_time("ts"), ["ts", "event_id"], ["k"], "times",
    )
    return lists.select("k", "ws", "chunk", F.array_join("times", ",").alias("times"))


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as s from events")
def q_format_time(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", format_time("ts").alias("s"))


# --- parsing -------------------------------------------------------------------


@query("""
select cast(user_id as varchar) as k, date_trunc('millisecond', ts) as ts from events""")
def q_csv_key_ts(spark: SparkSession, sf: str) -> DataFrame:
    millis = F.floor(epoch_micros("ts") / 1000).cast("bigint")
    lines = table(spark, sf, "events").select(F.concat_ws(",", "user_id", millis).alias("value"))
    return lines.select(*csv_key_ts("value")).withColumn("ts", utc_clock("ts"))


@query("""
select c_name as name, concat('client-', c_custkey) as client_id from customer""")
def q_csv_pair(spark: SparkSession, sf: str) -> DataFrame:
    line = F.concat("c_name", F.lit(",client-"), "c_custkey").alias("value")
    return table(spark, sf, "customer").select(line).select(*csv_pair("value"))


@query("select doc_id, contains(text, ',') as has_comma from documents")
def q_contains(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", F.contains(F.col("text"), F.lit(",")).alias("has_comma")
    )


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def q_json_field(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", json_field("props", "k", "bigint").alias("k"))


@query("select o_orderkey as id, o_orderpriority as group_code from orders")
def q_json_typed(spark: SparkSession, sf: str) -> DataFrame:
    # ids of finished orders are sent as text
    number = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("group_code"))
    text = F.struct(number["id"].cast("string").alias("id"), number["group_code"].alias("group_code"))
    message = F.when(F.col("o_orderstatus") == "F", F.to_json(text)).otherwise(F.to_json(number))
    return typed_rows(
        table(spark, sf, "orders").select(message.alias("value")), "value", "id bigint, group_code string"
    )


@query("""
select case when o_orderstatus <> 'P' then o_orderkey end as id,
       case when o_orderstatus <> 'F' then o_orderstatus end as group_code
from orders where o_orderpriority <> '5-LOW'""")
def q_json_lenient(spark: SparkSession, sf: str) -> DataFrame:
    # low-priority orders are cut short, pending ones have a bad id, finished ones lack a field
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    message = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit('{"id":'), key))
        .when(status == "P", F.concat(F.lit('{"id":"x'), key, F.lit('","group_code":"P"}')))
        .when(status == "F", F.concat(F.lit('{"id":'), key, F.lit("}")))
        .otherwise(F.to_json(F.struct(key.alias("id"), status.alias("group_code"))))
    )
    return typed_rows(
        table(spark, sf, "orders").select(message.alias("value")), "value",
        "id bigint, group_code string", lenient=True,
    )


@query("""
select c_custkey as id, c_name as name, cast(c_nationkey as bigint) as nation, c_mktsegment as tag, c_custkey + 1 as next
from customer""")
def q_json_nested(spark: SparkSession, sf: str) -> DataFrame:
    """A struct, an array and a map within a message."""
    message = F.to_json(F.struct(
        F.col("c_custkey").alias("id"), F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("who"),
        F.array("c_mktsegment").alias("tags"), F.create_map(F.lit("next"), F.col("c_custkey") + 1).alias("more"),
    ))
    rows = typed_rows(
        table(spark, sf, "customer").select(message.alias("value")), "value",
        "id bigint, who struct<name:string,nation:bigint>, tags array<string>, more map<string,bigint>",
    )
    return rows.select("id", "who.name", "who.nation", F.col("tags")[0].alias("tag"), F.col("more")["next"].alias("next"))


@query("select c_custkey + 1 as id, c_mktsegment as seg from customer")
def q_json_repeated_field(spark: SparkSession, sf: str) -> DataFrame:
    """Of a field given twice the last value counts, in reading and in writing."""
    message = F.concat(
        F.lit('{"id":'), "c_custkey", F.lit(',"seg":"'), "c_mktsegment", F.lit('","id":'), F.col("c_custkey") + 1, F.lit("}")
    )
    fields = put_field(json_object(message), "extra", F.lit("x"))
    written = table(spark, sf, "customer").select(json_text(fields).alias("m"))
    return typed_rows(written, "m", "id bigint, seg string, extra string").select("id", "seg")


def _customer_values(spark: SparkSession, sf: str) -> DataFrame:
    """JSON whose field ``v`` is a number, text, a flag or null by market segment."""
    segment = F.col("c_mktsegment")
    value = (
        F.when(segment == "BUILDING", F.col("c_acctbal").cast("string"))
        .when(segment == "AUTOMOBILE", F.concat(F.lit('"'), "c_custkey", F.lit('"')))
        .when(segment == "MACHINERY", F.concat(F.lit('"'), "c_name", F.lit('"')))
        .when(segment == "HOUSEHOLD", F.lit("true"))
        .otherwise(F.lit("null"))
    )
    message = F.concat(F.lit('{"id":'), "c_custkey", F.lit(',"v":'), value, F.lit("}"))
    return table(spark, sf, "customer").select(json_object(message).alias("f"))


@query("""
select c_custkey as id, case c_mktsegment when 'BUILDING' then cast(trunc(c_acctbal) as bigint)
  when 'AUTOMOBILE' then c_custkey when 'HOUSEHOLD' then 1 else 0 end as v
from customer""")
def q_json_aslong(spark: SparkSession, sf: str) -> DataFrame:
    f = F.col("f")
    return _customer_values(spark, sf).select(as_long(f["id"]).alias("id"), as_long(f["v"]).alias("v"))


@query("""
select c_custkey as id, case c_mktsegment when 'AUTOMOBILE' then concat('"', c_custkey, '"')
  when 'MACHINERY' then concat('"', c_name, '"') when 'HOUSEHOLD' then 'true'
  when 'BUILDING' then cast(cast(c_acctbal as decimal(18, 2)) as varchar)
  else 'null' end as v
from customer""")
def q_json_raw_text(spark: SparkSession, sf: str) -> DataFrame:
    f = F.col("f")
    text = raw_text(f["v"])
    # numbers are compared with two places
    two_places = F.when(text.rlike(r"^-?[0-9]"), text.try_cast("decimal(18,2)").cast("string"))
    return _customer_values(spark, sf).select(
        as_long(f["id"]).alias("id"), F.coalesce(two_places, text).alias("v")
    )


# --- lookups -------------------------------------------------------------------

_NAMES = {"view": "View", "click": "Click"}
_NAMED = """
events left join (values ('view', 'View'), ('click', 'Click')) d(et, event_name) on event_type = et"""


@query(f"""
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, event_name from {_NAMED}""")
def q_json_enrich(spark: SparkSession, sf: str) -> DataFrame:
    named = lookup_map(table(spark, sf, "events"), "event_type", _NAMES, "event_name")
    message = json_text(put_field(json_object("props"), "event_name", F.col("event_name")))
    return typed_rows(
        named.select("event_id", message.alias("m")), "m", "k bigint, event_name string", "event_id"
    )


@query(f"select event_id, event_type, event_name from {_NAMED}")
def q_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    return lookup_map(events, "event_type", _NAMES, "event_name")


@query("""
select o_orderkey, c_mktsegment from orders left join customer on o_custkey = c_custkey""")
def q_lookup_table(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lookup_join(orders, customer, "c_custkey").select("o_orderkey", "c_mktsegment")


@query("""
select o_orderkey, c_mktsegment from (
  select *, case o_orderkey % 3 when 0 then null when 1 then 1 else o_custkey end as k from orders)
left join customer on k = c_custkey""")
def q_lookup_skewed(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the rows have no key and a third the same one."""
    third = F.col("o_orderkey") % 3
    key = F.when(third == 0, None).when(third == 1, 1).otherwise(F.col("o_custkey")).cast("bigint")
    orders = table(spark, sf, "orders").select("o_orderkey", key.alias("c_custkey"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return lookup_join(orders, customer, "c_custkey").select("o_orderkey", "c_mktsegment")


@query("select o_orderkey, concat('x', o_custkey) as xuid from orders")
def q_service_lookup(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("client_id")
    )

    def fetch(keys):
        return [f"x{key}" for key in keys]

    return service_lookup(orders, "client_id", "xuid", fetch).select("o_orderkey", "xuid")


# --- messages, routing and offsets ---------------------------------------------

_MESSAGES = """
with msg as (
  select 'groups' as topic, c_custkey as id, c_mktsegment as group_code, null::varchar as group_id,
         cast(c_custkey % 3 as int) as partition_value, c_custkey // 3 as offset_value from customer
  union all
  select 'members', o_orderkey, null, cast(o_custkey as varchar),
         cast(o_orderkey % 3 as int), o_orderkey // 3 from orders)
"""


def _group_topic(customer: DataFrame) -> DataFrame:
    payload = F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("group_code"))
    return as_messages(customer, "groups", "c_custkey", payload)


def _member_topic(orders: DataFrame) -> DataFrame:
    payload = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("group_id")
    )
    return as_messages(orders, "members", "o_orderkey", payload)


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    return union_streams(
        _group_topic(table(spark, sf, "customer")), _member_topic(table(spark, sf, "orders"))
    )


def _positions(messages: DataFrame) -> DataFrame:
    return messages.select(
        "topic", F.col("partition").alias("partition_value"), F.col("offset").alias("offset_value")
    )


@query(f"""{_MESSAGES}
select topic, partition_value as "partition", offset_value as "offset", id from msg""")
def q_kafka_shape(spark: SparkSession, sf: str) -> DataFrame:
    return _messages(spark, sf).select(
        "topic", "partition", "offset", json_field(F.col("value").cast("string"), "id", "bigint").alias("id")
    )


@query(f"""{_MESSAGES}
select id, case when topic = 'groups' then 'group' else 'member' end as kind from msg""")
def q_route_kind(spark: SparkSession, sf: str) -> DataFrame:
    return route(_messages(spark, sf)).select("id", "kind")


@query(f"{_MESSAGES} select id, group_code from msg where topic = 'groups'")
def q_demux_group(spark: SparkSession, sf: str) -> DataFrame:
    return groups(route(_messages(spark, sf)))


@query(f"{_MESSAGES} select id, group_id from msg where topic = 'members'")
def q_demux_member(spark: SparkSession, sf: str) -> DataFrame:
    return members(route(_messages(spark, sf)))


@query(f"""{_MESSAGES}
select topic, partition_value, offset_value,
       case when id % 5 = 0 then 'corrupt' when topic = 'groups' then 'group' else 'member' end as kind,
       case when id % 5 = 0 then concat('{{"id":', id) end as text
from msg""")
def q_route_corrupt(spark: SparkSession, sf: str) -> DataFrame:
    """Each fifth message is cut short; it is kept as it came, with its position."""
    messages = _messages(spark, sf)
    text = F.col("value").cast("string")
    whole = json_field(text, "id", "bigint")
    cut = F.when(whole % 5 == 0, F.concat(F.lit('{"id":'), whole)).otherwise(text)
    routed = route(messages.withColumn("value", cut.cast("binary")))
    return routed.select("topic", "partition_value", "offset_value", "kind", F.col("value").cast("string").alias("text"))


@query(f"{_MESSAGES} select topic, count(*) as cnt from msg group by topic")
def q_union_topics(spark: SparkSession, sf: str) -> DataFrame:
    return keyed_totals(_messages(spark, sf), ["topic"])


_NEWEST = """
select topic, partition_value, max(offset_value) as {name} from msg group by topic, partition_value"""


@query(_MESSAGES + _NEWEST.format(name="max_offset"))
def q_offset_max(spark: SparkSession, sf: str) -> DataFrame:
    return newest(_positions(_messages(spark, sf))).withColumnRenamed("offset_value", "max_offset")


def _offset_history(spark: SparkSession, sf: str) -> DataFrame:
    """The newest offsets of each 30 s batch; messages are a second apart."""
    batches = assign_window(_messages(spark, sf), "timestamp", "30 seconds")
    positions = batches.select(
        "topic", F.col("partition").alias("partition_value"), F.col("offset").alias("offset_value"), "ws"
    )
    return newest(positions, "ws").withColumn("ws", utc_clock("ws"))


@query(f"""{_MESSAGES}
select topic, partition_value, max(offset_value) as max_offset,
       timestamp '2024-01-01' + to_seconds(offset_value // 30 * 30) as ws
from msg group by topic, partition_value, ws""")
def q_offset_batch_max(spark: SparkSession, sf: str) -> DataFrame:
    return _offset_history(spark, sf).withColumnRenamed("offset_value", "max_offset")


@query(_MESSAGES + _NEWEST.format(name="offset_value"))
def q_offset_compact(spark: SparkSession, sf: str) -> DataFrame:
    """A history table brought down to one row per source partition, in place."""
    name = f"offset_history_{uuid.uuid4().hex}"
    columns = "topic string, partition_value int, offset_value bigint, insert_time timestamp"
    recreate(spark, name, columns, "partition_value", 4)
    history = _offset_history(spark, sf).withColumn("insert_time", F.current_timestamp())
    history.select("topic", "partition_value", "offset_value", "insert_time").write.insertInto(name)
    compact_offset_table(spark, name)
    return spark.table(name).where("insert_time is not null").drop("insert_time")


@query("""
select o_orderkey as id, o_orderpriority as code, case when o_orderkey % 2 = 0 then o_orderstatus end as status
from orders""")
def q_table_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    """Created in buckets, widened, filled, refilled from its own rows, read back."""
    name = f"lifecycle_{uuid.uuid4().hex}"
    recreate(spark, name, "id bigint, code string", "id", 4)
    add_columns(spark, name, "status string")
    orders = table(spark, sf, "orders")
    rows = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("code"), F.col("o_orderstatus").alias("status"))
    rows.write.insertInto(name)
    even = F.when(F.col("id") % 2 == 0, F.col("status"))
    refill(spark.table(name).select("code", even.alias("status"), "id"), name)
    return spark.table(name)


@query("""
with stored as (
  select cast(o_orderkey % 3 as int) as partition_value, max(o_orderkey // 3) as m
  from orders where o_orderstatus = 'F' group by 1),
batch as (
  select cast(o_orderkey % 3 as int) as partition_value, max(o_orderkey // 3) as m
  from orders where o_orderstatus <> 'F' group by 1)
select 'members' as topic, partition_value, greatest(stored.m, batch.m) as max_offset
from stored full join batch using (partition_value)""")
def q_offset_merge(spark: SparkSession, sf: str) -> DataFrame:
    # finished orders were stored by an earlier run, the others are the batch
    orders, finished = table(spark, sf, "orders"), F.col("o_orderstatus") == "F"
    stored = newest(_positions(_member_topic(orders.where(finished))))
    batch = newest(_positions(_member_topic(orders.where(~finished))))
    return merge(stored, batch).withColumnRenamed("offset_value", "max_offset")


@query(f"""{_MESSAGES}
select topic, partition_value, max(offset_value) + 1 as start_offset
from msg group by topic, partition_value""")
def q_resume_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return next_offsets(_offset_history(spark, sf))


@query(f"{_MESSAGES} select id, group_code from msg where topic = 'groups'")
def q_sql_projection(spark: SparkSession, sf: str) -> DataFrame:
    json_view(_group_topic(table(spark, sf, "customer")), "group_source", "id bigint, group_code string")
    return project_view(spark, "group_source", ["id", "group_code"])


def _gaps(window: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Microseconds since the row before, over any number of batches."""
    last = None
    for batch in batches:
        times = batch["ts"].cast(pa.int64()).to_numpy()
        gaps = np.diff(times, prepend=times[0] if last is None else last)
        last = times[-1]
        yield pa.record_batch({"event_id": batch["event_id"], "gap": pa.array(gaps)})


@query("""
select event_id, coalesce(epoch_us(ts) - epoch_us(lag(ts) over (
  partition by user_id, time_bucket(interval 1 day, ts) order by ts, event_id)), 0)::bigint as gap
from events""")
def q_window_function(spark: SparkSession, sf: str) -> DataFrame:
    """A function over the sorted rows of each user's window: gaps between neighbours."""
    return over_windows(table(spark, sf, "events"), "ts", "1 day", ["ts", "event_id"], _gaps, "event_id long, gap long", ["user_id"])


@query(f"{_MESSAGES} select topic, partition_value, offset_value from msg")
def q_ctas_copy(spark: SparkSession, sf: str) -> DataFrame:
    name = f"offsets_copy_{uuid.uuid4().hex}"
    return copy_table(_positions(_messages(spark, sf)), name, new_path(spark, name))


# --- streams -------------------------------------------------------------------


def in_batches(
    spark: SparkSession, sf: str, keys: dict[str, str], start: Callable[..., StreamingQuery], parts: int = 4
) -> None:
    """Run a query over several batches, restarted before each.

    The tables named in ``keys`` are written into growing folders, in ``parts`` by the
    column given. ``start`` gets a stream of each folder, and what a part adds is a batch: by a
    number of files there would be more batches the larger the tables are, each of which has
    tasks for all its shuffle partitions, and files of a part would come in any order.
    """
    path = new_path(spark, "parts")
    sources = {name: table(spark, sf, name) for name in keys}
    last = {name: sources[name].agg(F.max(key)).first()[0] or 0 for name, key in keys.items()}
    for i in range(parts):
        for name, key in keys.items():
            part = F.floor(F.col(key) * parts / F.lit(last[name] + 1))
            sources[name].where(part == i).write.mode("append").parquet(f"{path}/{name}")
        streams = [spark.readStream.schema(sources[name].schema).parquet(f"{path}/{name}") for name in keys]
        start(*streams).awaitTermination()


@query(f"""
select * from ({_TUMBLING})
where we - interval 1 millisecond
      <= (select date_trunc('millisecond', max(ts)) from events) - interval 10 seconds""")
def q_stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """The windows an append-mode stream has closed when the table ends."""
    session = streaming_session(spark)
    path = new_path(session, "tumbling")

    def start(events: DataFrame) -> StreamingQuery:
        late = with_bounded_lateness(events.withColumnRenamed("user_id", "k"), "ts", 10)
        return start_files(tumbling(late, "ts", "1 hour", ["k"]), f"{path}/out", f"{path}/checkpoint")

    in_batches(session, sf, {"events": "event_id"}, start)
    times = {c: utc_clock(c) for c in ("min_ts", "max_ts", "ws", "we")}
    return session.read.parquet(f"{path}/out").withColumns(times)


@query(f"""
select * from ({ORACLES["q_window_collect_chunked"]})
where ws + interval 1 day - interval 1 millisecond
      <= (select date_trunc('millisecond', max(ts)) from events) - interval 10 seconds""")
def q_stream_window_collect(spark: SparkSession, sf: str) -> DataFrame:
    """The lists of windows that a stream has closed when the table ends."""
    session = streaming_session(spark)
    path = new_path(session, "lists")
    write = lists_to_folder(f"{path}/out", ["ts", "event_id"], name="ids", chunk_rows=25, rows_per_range=FEW_ROWS)

    def start(events: DataFrame) -> StreamingQuery:
        late = with_bounded_lateness(events.select("event_id", "ts"), "ts", 10)
        closed = closed_rows(late, "ts", "1 day", F.col("event_id").cast("string"), ["ts", "event_id"])
        return start_batches(closed, write, f"{path}/checkpoint")

    in_batches(session, sf, {"events": "event_id"}, start)
    lists = session.read.parquet(f"{path}/out").drop("batch_id")
    return lists.withColumns({"ws": utc_clock("ws"), "ids": F.array_join("ids", ",")})


@query(ORACLES["q_word_count"])
def q_stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    session = streaming_session(spark)
    path = new_path(session, "words")

    def start(documents: DataFrame) -> StreamingQuery:
        totals = keyed_totals(tokens(documents, "text"), ["word"], value="n")
        return start_batches(totals, updates_to_folder(f"{path}/out"), f"{path}/checkpoint", mode="update")

    in_batches(session, sf, {"documents": "doc_id"}, start)
    return latest_totals(session.read.parquet(f"{path}/out"), ["word"], "cnt")


@query(_RUNNING_COUNT)
def q_stream_running_count(spark: SparkSession, sf: str) -> DataFrame:
    session = streaming_session(spark)
    path = new_path(session, "changelog")
    write = changelog_to_folder(f"{path}/out", ["event_type"], ["event_id"], "running_cnt")
    in_batches(session, sf, {"events": "event_id"}, lambda events: start_batches(
        events.select("event_id", "event_type"), write, f"{path}/checkpoint"
    ))
    return session.read.parquet(f"{path}/out/changes").drop("batch_id")


@query("""
select event_id, sum(event_id % 100) over (
  partition by user_id order by event_id rows between unbounded preceding and current row)::bigint as reached
from events""")
def q_stream_running_sum(spark: SparkSession, sf: str) -> DataFrame:
    session = streaming_session(spark)
    path = new_path(session, "sums")
    write = changelog_to_folder(f"{path}/out", ["user_id"], ["event_id"], "reached", "n", rows_per_range=FEW_ROWS, buckets=3)
    in_batches(session, sf, {"events": "event_id"}, lambda events: start_batches(
        events.select("event_id", "user_id", (F.col("event_id") % 100).alias("n")), write, f"{path}/checkpoint"
    ))
    return session.read.parquet(f"{path}/out/changes").select("event_id", "reached")


@query(ORACLES["q_watermark_trace"])
def q_stream_watermark_trace(spark: SparkSession, sf: str) -> DataFrame:
    session = streaming_session(spark)
    path = new_path(session, "trace")
    write = trace_to_folder(f"{path}/out", "ts", "10 SECONDS", ["sp"], ["event_id"])
    in_batches(session, sf, {"events": "event_id"}, lambda events: start_batches(
        events.select("event_id", "ts", (F.col("user_id") % 8).alias("sp")), write, f"{path}/checkpoint"
    ))
    return session.read.parquet(f"{path}/out/rows").select("event_id", "max_ts", "wm")


@query(ORACLES["q_service_lookup"])
def q_stream_service_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of later batches are mostly known from earlier ones."""
    session = streaming_session(spark)
    path = new_path(session, "lookups")
    write = answers_to_folder(f"{path}/out", "client_id", "xuid", lambda keys: [f"x{key}" for key in keys], buckets=3)
    in_batches(session, sf, {"orders": "o_orderkey"}, lambda orders: start_batches(
        orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("client_id")), write, f"{path}/checkpoint"
    ))
    return session.read.parquet(f"{path}/out/rows").select("o_orderkey", "xuid")


def _committed(spark: SparkSession, sf: str) -> tuple[SparkSession, str]:
    session = streaming_session(spark)
    path = new_path(session, "commits")
    write = commit_to_folder(f"{path}/out")
    in_batches(session, sf, {"customer": "c_custkey", "orders": "o_orderkey"}, lambda customer, orders: messages_to_tables(
        union_streams(_group_topic(customer), _member_topic(orders)), write, f"{path}/checkpoint", every=None
    ))
    return session, f"{path}/out"


@query(f"""{_MESSAGES}
select case when topic = 'groups' then 'group' else 'member' end as kind, * from msg""")
def q_stream_commit(spark: SparkSession, sf: str) -> DataFrame:
    return committed_rows(*_committed(spark, sf)).drop("run", "batch_id", "value")


@query(_MESSAGES + _NEWEST.format(name="offset_value"))
def q_stream_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """From a history of which the older batches were gathered in a snapshot."""
    session, root = _committed(spark, sf)
    compact_folder(session, root, keep=1)
    return compact(stored_offsets(session, root))
