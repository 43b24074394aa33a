"""Users who come after their clicks, and throughput observed on the way."""

import datetime as dt

import pytest
from conftest import at, rows
from pyspark.errors import StreamingQueryException

from stallbook import streaming as live
from stallbook.operators import monitor
from stallbook.plans.staging import new_folder

CLICKS = "event_id string, user_id bigint, seen timestamp"
USERS = "user_id bigint, joined timestamp, city string"


class Parts:
    """A stream of the given lists of rows, a micro-batch each."""

    def __init__(self, spark, schema, *parts):
        self.spark, self.schema, self.folder = spark, schema, new_folder(spark, "parts")
        self.every = [row for part in parts for row in part]
        for n, part in enumerate(parts):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{self.folder}/part={n}")

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.folder}/part=*")

    def batch(self):
        return self.spark.createDataFrame(self.every, self.schema)


def hour(n):
    return at("2024-01-01") + dt.timedelta(hours=n)


def test_late_users_join_and_others_come_out_once(spark):
    clicks = Parts(
        spark, CLICKS,
        [("early", 1, hour(0)), ("alone", 2, hour(0)), ("nobody", None, hour(0)), ("undated", 1, None)],
        [("known", 1, hour(5)), ("far", 3, hour(6))],
        [("end", -1, hour(500))],
    )
    users = Parts(
        spark, USERS,
        [(9, hour(0), "Bonn")],
        [(1, hour(3), "Oslo"), (3, hour(40), "Rome"), (4, None, "Lima")],
        [(-2, hour(500), "")],
    )
    join = lambda c, u: live.enrich_late(c, u, "user_id", "seen", "joined")
    # the closing row waits itself; on the stream this filter would be pushed below the watermark
    found = live.run_to_table(join(clicks.stream(), users.stream()), "late").where("event_id <> 'end'")
    batch = join(clicks.batch(), users.batch()).where("event_id <> 'end'")
    assert rows(found, "event_id") == rows(batch, "event_id")
    cities = {r["event_id"]: r["city"] for r in found.collect()}
    assert cities == {"early": "Oslo", "alone": None, "nobody": None, "known": "Oslo", "far": None}


def test_a_click_waits_until_no_user_can_come(spark):
    clicks = Parts(spark, CLICKS, [("open", 1, hour(50)), ("closed", 1, hour(0))], [("last", 1, hour(60))])
    users = Parts(spark, USERS, [(9, hour(60), "Bonn")], [(9, hour(61), "Bonn")])
    found = live.run_to_table(live.enrich_late(clicks.stream(), users.stream(), "user_id", "seen", "joined"), "late")
    assert [r["event_id"] for r in rows(found)] == ["closed"]


def test_readings_equal_the_table(spark):
    parts = [[(f"{n}{i}", i, hour(n) + dt.timedelta(seconds=i)) for i in range(10 * (n + 1))] for n in range(3)]
    feed = Parts(spark, CLICKS, *parts, [("undated", 1, None)])
    folder = new_folder(spark, "metered")
    meter = live.BatchMeter(spark, f"{folder}/readings", "seen")
    assert rows(meter.readings()) == rows(meter.scorecard(1.0)) == []
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/table/batch={number}")
    live.stream_to_gold(feed.stream(), meter.measured(write), f"{folder}/state").awaitTermination()
    assert spark.read.parquet(f"{folder}/table").count() == 61
    found = rows(meter.readings(), "batch")
    assert [(r["events"], r["undated"]) for r in found] == [(10, 0), (20, 0), (30, 0), (1, 1)]
    assert [r["last"] for r in found] == [hour(0) + dt.timedelta(seconds=9), hour(1) + dt.timedelta(seconds=19),
                                          hour(2) + dt.timedelta(seconds=29), None]
    cards = rows(meter.scorecard(1.0, 30.0), "batch")
    table = rows(monitor.throughput_scorecard(feed.batch().dropna(), "seen", 1.0), "step_start")
    for card, step in zip(cards[:3], table, strict=True):
        assert {k: card[k] for k in ("events", "actual_rate", "success_pct", "status")} == {
            k: step[k] for k in ("events", "actual_rate", "success_pct", "status")
        }
    assert [r["status"] for r in cards] == ["FAIL", "FAIL", "PASS", "FAIL"]
    assert rows(meter.scorecard(1.0), "batch")[3]["actual_rate"] is None


def test_a_batch_that_fails_is_measured_when_it_is_written(spark):
    feed = Parts(spark, CLICKS, [("a", 1, hour(0))], [("b", 1, hour(1)), ("c", 1, hour(2))])
    folder = new_folder(spark, "metered")
    meter = live.BatchMeter(spark, f"{folder}/readings", "seen")
    dies = {1}

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/table/batch={number}")
        if number in dies:
            dies.remove(number)
            raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        live.stream_to_gold(feed.stream(), meter.measured(write), f"{folder}/state").awaitTermination()
    assert [r["events"] for r in rows(meter.readings())] == [1]
    live.stream_to_gold(feed.stream(), meter.measured(write), f"{folder}/state").awaitTermination()
    assert [r["events"] for r in rows(meter.readings(), "batch")] == [1, 2]
