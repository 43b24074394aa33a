"""Earliest copies on a stream, and appends that count once."""

import datetime as dt

import pytest
from conftest import at, rows
from pyspark.errors import StreamingQueryException
from test_streaming import Feed

from stallbook import streaming as live
from stallbook.plans.staging import new_folder


def ids(frame):
    return sorted(r["event_id"] for r in frame.select("event_id").collect())


def test_a_late_original_replaces_its_copy(spark):
    source = Feed(spark)
    source.add([("a", 1, "copy", 5.0), ("b", 1, "only", 6.0), ("c", 9, "copy", 8.0)])
    source.add([("a", 1, "first", 2.0), ("c", 9, "first", 7.0), ("c", 9, "tie", 7.0)])
    source.add([("z", 1, "last", 300.0)])
    build = lambda frame: live.earliest_events(frame, "event_id", "ts", "20 minutes", "30 minutes")
    streamed = live.run_to_table(build(source.stream()), "earliest")
    batch = build(source.batch()).where("event_id <> 'z'")  # z is open still
    assert rows(streamed, "event_id") == rows(batch, "event_id")
    assert {r["event_id"]: r["event_type"] for r in streamed.collect()} == {"a": "first", "b": "only", "c": "first"}
    assert streamed.columns == ["event_id", "user_id", "event_type", "ts", "amount"]


def test_rows_without_key_or_time_are_left_out(spark):
    frame = spark.createDataFrame([("a", None), (None, at("2024-01-01")), ("b", at("2024-01-01"))], "event_id string, ts timestamp")
    assert ids(live.earliest_events(frame, "event_id", "ts")) == ["b"]


class Table:
    """A sink that only appends, in a folder."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path = spark, schema, new_folder(spark, "sink")
        spark.createDataFrame([], schema).write.parquet(self.path)

    def load(self):
        return self.spark.read.schema(self.schema).parquet(self.path)

    def add(self, frame):
        frame.write.mode("append").parquet(self.path)


@pytest.fixture
def source(spark):
    feed = Feed(spark)
    feed.add([("a", 1, "x", 0.0), ("a", 1, "x", 0.0), ("b", 1, "x", 1.0)])
    feed.add([("b", 1, "x", 1.0), ("c", 1, "x", 2.0)])
    return feed


@pytest.mark.parametrize("dies", ["before", "after"])
def test_a_batch_that_is_repeated_adds_nothing(spark, source, dies):
    table = Table(spark, source.batch().schema)
    log = live.CommitLog(spark, new_folder(spark, "commits"))
    append = live.append_new(table.load, table.add, "event_id", "ts")
    left, calls = [1], []

    def write(batch, number):
        calls.append(number)
        if dies == "before" and number in left:
            left.remove(number)
            raise RuntimeError("lost")
        append(batch, number)
        if number in left:
            left.remove(number)
            raise RuntimeError("lost")

    state = new_folder(spark, "state")
    with pytest.raises(StreamingQueryException):
        live.stream_to_gold(source.stream(), live.once_per_batch(write, log), state).awaitTermination()
    live.stream_to_gold(source.stream(), live.once_per_batch(write, log), state).awaitTermination()
    assert ids(table.load()) == ["a", "b", "c"] and calls == [0, 1, 1]
    assert sorted((r.batch, r.rows) for r in log.records().collect()) == [(0, 3), (1, 2)]


def test_a_recorded_batch_is_not_written_even_by_a_plain_sink(spark, source):
    table = Table(spark, source.batch().schema)
    log = live.CommitLog(spark, new_folder(spark, "commits"))
    write = live.once_per_batch(lambda batch, number: table.add(batch), log)
    batch = source.batch()
    for number in (0, 0, 1, 0):
        write(batch, number)
    assert table.load().count() == 2 * batch.count()
