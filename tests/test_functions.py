"""Expressions on the sample records and their edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions.messages import (
    as_long, has_key, json_field, json_object, json_text, put_field, raw_text, typed_rows,
)
from millrace.functions.text import csv_key_ts, csv_pair, split_tokens, tokens, topic_list
from millrace.functions.times import epoch_micros, format_time, utc_clock, wall_clock
from millrace.sources.views import tokens_function


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expr).collect()]


@pytest.mark.parametrize("separator", [" ", ",", "."])
def test_split_drops_trailing_empty_tokens(spark, separator):
    lines = [x.replace(" ", separator) for x in ["a b", "a  b ", "", "  ", " a", "a", "a   "]]
    want = [["a", "b"], ["a", "", "b"], [""], [], ["", "a"], ["a"], ["a"]]
    assert column(spark, lines, split_tokens("v", separator)) == want


def test_tokens_are_paired_with_one(spark):
    df = spark.createDataFrame([(1, "a b\n\na ")], "id int, text string")
    got = [tuple(r) for r in tokens(df, "text", "id").collect()]
    assert got == [(1, "a", 1), (1, "b", 1), (1, "", 1), (1, "a", 1)]


def test_the_sql_function_gives_the_same_tokens_without_a_join(spark):
    texts = ["a b", "a  b ", "", "  ", " a", None, "a b\n\n  \n a ", "a b", "\n", "  \n  \nb", "a  \n", "a\n   ", "\n  \n\n", "é\r\n ü\t \n\u2028x \u3000", "a" + " " * 200_000 + "b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    df.createOrReplaceTempView("lines_of_test")
    tokens_function(spark, "tokens_of_test")
    got = spark.sql("SELECT id, word, n FROM lines_of_test, LATERAL tokens_of_test(text)")
    assert got.schema == tokens(df, "text", "id").schema
    assert sorted(got.collect()) == sorted(tokens(df, "text", "id").collect())
    # a join by the text would shuffle every text and every token with its text
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_topic_list():
    assert topic_list("event") == ["event"]
    assert topic_list("a,b") == ["a", "b"]


def test_key_time_line(spark):
    df = spark.createDataFrame([("0001,1790820682000",)], "value string")
    row = df.select(*csv_key_ts("value")).select("k", utc_clock("ts").alias("ts")).first()
    assert tuple(row) == ("0001", dt.datetime(2026, 10, 1, 2, 11, 22))


def test_bad_key_time_line_fails_unless_lenient(spark):
    df = spark.createDataFrame([("a,x",), ("a",), ("b,5",)], "value string")
    with pytest.raises(Exception):
        df.select(*csv_key_ts("value")).collect()
    got = df.select(*csv_key_ts("value", lenient=True)).select("k", F.unix_millis("ts")).collect()
    assert [tuple(r) for r in got] == [("a", None), ("a", None), ("b", 5)]


def test_name_client_line(spark):
    df = spark.createDataFrame([("ines,device-31",)], "value string")
    assert tuple(df.select(*csv_pair("value")).first()) == ("ines", "device-31")


def test_event_gets_its_name(spark):
    event = "{event_id: '1001', kind: 35, page: 'start', device: 'tablet-9'}"
    named = json_text(put_field(json_object("v"), "event_name", F.lit("1001name")))
    got = column(spark, [event], F.from_json(named, "map<string,string>"))[0]
    assert got == {
        "event_id": "1001", "kind": "35", "page": "start", "device": "tablet-9",
        "event_name": "1001name",
    }
    unnamed = json_text(put_field(json_object("v"), "event_name", F.lit(None).cast("string")))
    assert "event_name" not in column(spark, [event], F.from_json(unnamed, "map<string,string>"))[0]


def test_put_field_replaces(spark):
    expr = json_text(put_field(json_object("v"), "a", F.lit("new")))
    assert column(spark, ['{"a":1}'], expr) == ['{"a":"new"}']


def test_json_keeps_large_numbers(spark):
    message = '{"id":9007199254740993,"group_code":"test"}'
    assert column(spark, [message], json_field("v", "id", "bigint")) == [9007199254740993]
    assert column(spark, [message], as_long(json_object("v")["id"])) == [9007199254740993]


def test_key_presence(spark):
    messages = ['{"group_code":null}', '{"id":1}', "not json"]
    assert column(spark, messages, has_key(json_object("v"), "group_code")) == [True, False, None]


def test_as_long(spark):
    values = ["2", '"77"', '"abc"', "5.7", '"5.7"', "true", "null", "1e30", "-1e30", "-5.7"]
    messages = [f'{{"id":{v}}}' for v in values] + ["{}"]
    want = [2, 77, 0, 5, 5, 1, 0, 2**63 - 1, -(2**63), -5, None]
    assert column(spark, messages, as_long(json_object("v")["id"])) == want


def test_raw_text(spark):
    messages = ['{"g":"x"}', '{"g":5}', '{"g":null}', '{"g":{"a":[1]}}', "{}"]
    want = ['"x"', "5", "null", '{"a":[1]}', None]
    assert column(spark, messages, raw_text(json_object("v")["g"])) == want


def test_typed_rows(spark):
    df = spark.createDataFrame([('{"id":"77","x":1}',), ("{id: 1001, group_code: 'g'}",)], "m string")
    got = typed_rows(df, "m", "id bigint, group_code string").collect()
    assert [tuple(r) for r in got] == [(77, None), (1001, "g")]


def test_typed_rows_leniency(spark):
    messages = ['{"id":1,"group_code":5}', "not json", '{"id":"abc","group_code":"g"}', '{"id":2', None]
    df = spark.createDataFrame([(m,) for m in messages], "m string")
    got = typed_rows(df, "m", "id bigint, group_code string", lenient=True).collect()
    assert sorted(got, key=str) == sorted([(1, "5"), (None, "g")], key=str)
    for bad in ("not json", '{"id":"abc"}'):
        with pytest.raises(Exception):
            typed_rows(df.where(F.col("m") == bad), "m", "id bigint").union(
                typed_rows(spark.createDataFrame([(bad,)], "m string"), "m", "id bigint")
            ).collect()


def test_wall_clock_of_the_sample(spark):
    text = format_time(wall_clock(F.col("v").cast("bigint"), "Asia/Shanghai"))
    assert column(spark, ["1790820682000", "1790820672000", "1790820682999"], text) == [
        "2026-10-01 10:11:22", "2026-10-01 10:11:12", "2026-10-01 10:11:22",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", zone)
    # these wall clocks are skipped or doubled in New York
    clocks = ["2024-03-10 02:30:00.25", "2024-03-10 03:10:00", "2024-11-03 01:30:00"]
    df = session.createDataFrame([(c,) for c in clocks], "c string").select(
        F.col("c").cast("timestamp_ntz").alias("ts")
    )
    rows = df.select(
        epoch_micros("ts").alias("us"), format_time("ts").alias("s"),
    ).collect()
    want = [dt.datetime.fromisoformat(c + "0000" if "." in c else c) for c in clocks]
    micros = [(w - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1) for w in want]
    assert [r.us for r in rows] == micros
    assert [r.s for r in rows] == [f"{w:%Y-%m-%d %H:%M:%S}" for w in want]


def test_the_last_of_repeated_fields_counts(spark):
    messages = ['{"a":1,"b":2,"a":3}', '{"a":1}', "{}", "no", '{"a":null,"a":{"x":null}}']
    written = column(spark, messages, json_text(put_field(json_object("v"), "c", F.lit(9))))
    assert written == ['{"b":2,"a":3,"c":9}', '{"a":1,"c":9}', '{"c":9}', None, '{"a":{"x":null},"c":9}']


@pytest.mark.parametrize("lenient", [False, True])
def test_nested_types_are_decoded(spark, lenient):
    df = spark.createDataFrame([('{"n":"5","s":{"a":1,"l":[1,2]},"m":{"k":[{"z":true}]}}',)], "v string")
    row = typed_rows(df, "v", "n int, s struct<a:int,l:array<int>>, m map<string,array<struct<z:boolean>>>", lenient=lenient).first()
    assert (row.n, row.s.a, row.s.l, row.m["k"][0].z) == (5, 1, [1, 2], True)
