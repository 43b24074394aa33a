import datetime as dt

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from stallbook import streaming as live
from stallbook.plans.staging import new_folder
from stallbook.streaming.windows import interval_seconds

SCHEMA = "event_id string, user_id int, event_type string, ts timestamp, amount decimal(10,2)"


class Feed:
    """A folder that receives files, one per batch."""

    def __init__(self, spark):
        self.spark = spark
        self.folder = new_folder(spark, "feed")
        self.number = 0

    def add(self, events):
        """Events are (id, user, type, minute offset)."""
        start = at("2024-01-01 10:00:00")
        data = [(i, u, t, start + dt.timedelta(minutes=m), None) for i, u, t, m in events]
        frame = self.spark.createDataFrame(data, SCHEMA).withColumn("amount", F.lit(1.5).cast("decimal(10,2)"))
        frame.coalesce(1).write.mode("append").parquet(f"{self.folder}/batch{self.number}")
        self.number += 1

    def stream(self, files_per_batch=1):
        reader = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(f"{self.folder}/batch*")

    def batch(self):
        return self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/batch*")


@pytest.fixture
def feed(spark):
    source = Feed(spark)
    source.add([("a", 1, "view", 0.1), ("b", 1, "view", 0.9), ("c", 2, "click", 3.5)])
    source.add([("d", 2, "view", 4.2), ("e", 3, "click", 61.0)])
    return source


CASES = {
    "minutes": lambda f: live.orders_per_minute(f, "ts"),
    "hours": lambda f: live.hourly_amount(f, "ts", "amount"),
    "rates": lambda f: live.rolling_rate(f, "ts"),
    "mix": lambda f: live.event_mix(f, "ts", "event_type"),
    "funnel": lambda f: live.daily_funnel(f, "ts"),
    "kpis": lambda f: live.rolling_kpis(f, "ts", "amount", "user_id"),
}


@pytest.mark.parametrize("name", ["minutes", "hours", "mix", "funnel"])
def test_complete_stream_equals_batch(feed, name):
    streamed = live.run_to_table(CASES[name](feed.stream()), name, mode="complete")
    assert sorted(map(str, streamed.collect())) == sorted(map(str, CASES[name](feed.batch()).collect()))


@pytest.mark.parametrize("name", CASES)
def test_append_stream_gives_the_closed_windows(feed, name):
    expected = sorted(map(str, CASES[name](feed.batch()).collect()))
    feed.add([("z", 9, "click", 60 * 24 * 5)])
    streamed = live.run_to_table(CASES[name](feed.stream()), name)
    assert sorted(map(str, streamed.collect())) == expected


def test_rate_divides_by_the_window_length(feed):
    found = live.rolling_rate(feed.batch(), "ts").agg(F.max("events"), F.max("tx_per_sec")).first()
    assert tuple(found) == (4, 4 / 300)
    assert interval_seconds("2 hours") == 7200
    with pytest.raises(ValueError):
        interval_seconds("1 month")


def test_exact_customers_in_a_batch(feed):
    found = live.rolling_kpis(feed.batch(), "ts", "amount", "user_id", window="1 day", slide="1 day", exact=True)
    assert found.first()["customers"] == 3


def test_append_mode_drops_late_rows_and_holds_back_open_windows(spark):
    source = Feed(spark)
    source.add([("a", 1, "view", 0.0)])
    source.add([("b", 1, "view", 60.0)])  # moves the watermark to minute 50
    source.add([("b2", 1, "view", 60.2)])  # rows are judged by the watermark of the batch before
    source.add([("late", 1, "view", 0.5), ("in time", 1, "view", 55.0)])
    source.add([("c", 1, "view", 120.0)])
    found = live.run_to_table(live.orders_per_minute(source.stream(), "ts"), "late", mode="append")
    assert [(r["window_start"].hour, r["window_start"].minute, r["orders"]) for r in rows(found, "window_start")] == [
        (10, 0, 1),
        (10, 55, 1),
        (11, 0, 2),
    ]


def test_dedup_drops_repeated_keys(spark):
    source = Feed(spark)
    source.add([("a", 1, "view", 0.0), ("b", 1, "view", 1.0)])
    source.add([("a", 1, "view", 2.0), ("c", 1, "view", 3.0)])
    unique = live.run_to_table(live.dedup_events(source.stream(), "event_id", "ts"), "unique", mode="append")
    assert [r["event_id"] for r in rows(unique, "event_id")] == ["a", "b", "c"]
    assert live.dedup_events(source.batch(), "event_id", "ts").count() == 3


def test_appending_ignores_known_keys(spark):
    source = Feed(spark)
    source.add([("a", 1, "view", 0.0), ("b", 1, "view", 1.0), ("a", 1, "view", 2.0)])
    source.add([("b", 1, "view", 3.0), ("c", 1, "view", 4.0)])
    table = new_folder(spark, "appended")
    spark.createDataFrame([("b", 9, "old", None, None)], SCHEMA).write.parquet(table)
    append = live.append_new(
        lambda: spark.read.schema(SCHEMA).parquet(table), lambda f: f.write.mode("append").parquet(table), "event_id"
    )
    live.stream_to_gold(source.stream(), append, new_folder(spark, "state")).awaitTermination()
    stored = rows(spark.read.schema(SCHEMA).parquet(table), "event_id")
    assert [r["event_id"] for r in stored] == ["a", "b", "c"]
    assert stored[1]["event_type"] == "old"


def test_appending_reads_only_the_time_range_of_the_batch(spark):
    source = Feed(spark)
    source.add([("a", 1, "view", 0.0), ("b", 1, "view", 60.0)])
    table = new_folder(spark, "ranged")
    source.batch().write.parquet(table)
    source.add([("b", 1, "view", 60.0), ("c", 1, "view", 61.0)])
    read = []

    def known():
        read.append(spark.read.schema(SCHEMA).parquet(table))
        return read[-1]

    append = live.append_new(known, lambda f: f.write.mode("append").parquet(table), "event_id", "ts")
    for _ in range(2):
        append(spark.read.schema(SCHEMA).parquet(f"{source.folder}/batch1"), 0)
    assert [r["event_id"] for r in rows(spark.read.schema(SCHEMA).parquet(table), "event_id")] == ["a", "b", "c"]


def test_restart_from_the_checkpoint_adds_nothing(spark, feed):
    checkpoint = new_folder(spark, "state")
    seen = []

    def count(batch, number):
        seen.append((number, batch.count()))

    for _ in range(2):
        live.stream_to_gold(feed.stream(), count, checkpoint).awaitTermination()
    assert sum(n for _, n in seen) == 5
    feed.add([("f", 1, "view", 62.0)])
    live.stream_to_gold(feed.stream(), count, checkpoint).awaitTermination()
    assert sum(n for _, n in seen) == 6


def test_stream_joins_static_users(spark, shop):
    folder = new_folder(spark, "clicks")
    shop.clicks.write.parquet(folder)
    stream = spark.readStream.schema(shop.clicks.schema).parquet(folder)
    stream = stream.withColumn("metadata", F.struct(F.lit("/").alias("url"), "metadata.session_duration_sec"))
    joined = live.enrich_stream(stream, shop.users, ["city"])
    found = live.run_to_table(joined.select("event_id", "duration_sec", "city"), "joined", mode="append")
    assert [(r["event_id"], r["city"]) for r in rows(found, "event_id")] == [
        ("e1", "Oslo"),
        ("e2", "Oslo"),
        ("e3", "Rome"),
        ("e4", None),
    ]


def test_event_time_accepts_text_and_zoneless_times(spark):
    text = spark.createDataFrame([("2024-01-01T10:00:00",), ("nonsense",)], "ts string")
    assert [r["ts"] for r in live.event_time(text, "ts").collect()] == [at("2024-01-01 10:00:00"), None]
    zoneless = text.limit(1).select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert dict(live.event_time(zoneless, "ts").dtypes)["ts"] == "timestamp"


def test_a_stream_without_rows_gives_an_empty_table(spark):
    source = Feed(spark)
    source.add([])
    assert live.run_to_table(live.orders_per_minute(source.stream(), "ts"), "none").collect() == []
