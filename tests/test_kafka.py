"""The options given to the Kafka reader, and tables in the shape of messages.

The connector is not installed here, so a recording reader stands for it.
"""

import json

import pytest
from pyspark.sql import functions as F

from millrace.plans import jobs
from millrace.sources.kafka import as_messages, kafka_messages


class Reader:
    def __init__(self, log):
        self.log, self.given = log, {}

    def format(self, name):
        assert name == "kafka"
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def load(self):
        self.log.append(self.given)
        return self.given


class Session:
    def __init__(self, log):
        self.log = log

    @property
    def readStream(self):
        return Reader(self.log)


def test_one_topic_starts_at_the_latest_record():
    assert kafka_messages(Session([]), "b:9092", "event") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "event", "startingOffsets": "latest",
    }


def test_several_topics_and_limits():
    got = kafka_messages(
        Session([]), "b:9092", "groups,members", "earliest", 1000, 64, **{"kafka.group.id": "g"}
    )
    assert got["subscribe"] == "groups,members" and got["startingOffsets"] == "earliest"
    assert got["maxOffsetsPerTrigger"] == 1000 and got["minPartitions"] == 64
    assert got["kafka.group.id"] == "g"


def test_each_topic_resumes_after_its_stored_offsets(spark, monkeypatch):
    log = []
    monkeypatch.setattr(jobs, "union_streams", lambda *frames: frames)
    stored = spark.createDataFrame(
        [("groups", 0, 5), ("groups", 0, 9)], "topic string, partition_value int, offset_value bigint"
    )
    topics = {"groups": [0, 1], "members": [0]}
    assert len(jobs.resuming_messages(Session(log), "b:9092", stored, topics, min_partitions=8)) == 2
    assert json.loads(log[0]["startingOffsets"]) == {"groups": {"0": 10, "1": -2}}
    assert log[1]["startingOffsets"] == "earliest" and log[1]["minPartitions"] == 8


def test_without_the_connector_the_reader_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "b:9092", "event")


def test_rows_as_messages(spark):
    df = as_messages(spark.range(10), "t", "id", F.struct("id"), partitions=4)
    rows = df.select("partition", "offset", F.col("value").cast("string").alias("v"), "timestamp").collect()
    assert sorted((r.partition, r.offset, r.v) for r in rows) == sorted(
        (i % 4, i // 4, f'{{"id":{i}}}') for i in range(10)
    )
