from decimal import Decimal as D

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from stallbook.operators import monitor


@pytest.fixture(scope="module")
def orders(spark):
    data = [
        (1, 1, at("2024-01-01 10:00:00"), "10.00"),
        (2, 1, at("2024-01-02 09:00:00"), "20.00"),  # exactly one day before the last
        (3, 2, at("2024-01-03 08:00:00"), "30.00"),  # exactly one hour before the last
        (4, 2, at("2024-01-03 08:00:01"), "40.00"),
        (5, 3, at("2024-01-03 08:55:01"), None),
        (6, 3, at("2024-01-03 09:00:00"), "60.00"),
    ]
    full = [(i, u, t, None if a is None else D(a)) for i, u, t, a in data]
    return spark.createDataFrame(full, "order_id int, user_id int, order_date timestamp, amount decimal(10,2)")


def test_live_figures_exclude_the_edge_of_each_interval(orders):
    row = monitor.live_kpis(orders).first()
    assert (row["total_orders"], row["hourly_orders"], row["min5_orders"]) == (6, 3, 2)
    assert row["daily_revenue"] == D("130.00") and row["unique_customers"] == 3
    assert row["avg_order_value"] == 32.0 and row["tx_per_sec"] == 2 / 300
    assert row["last_order"] == at("2024-01-03 09:00:00")


def test_live_figures_at_a_given_time_and_of_nothing(orders):
    later = monitor.live_kpis(orders, as_of=F.lit(at("2024-02-01"))).first()
    assert (later["hourly_orders"], later["last_order"], later["daily_revenue"]) == (0, None, D("0.00"))
    empty = monitor.live_kpis(orders.limit(0)).first()
    assert (empty["total_orders"], empty["avg_order_value"]) == (0, 0.0)


def test_recent_orders_come_newest_first_with_unknown_users(shop):
    stranger = shop.orders.limit(1).withColumns({"user_id": F.lit(99), "order_date": F.lit(at("2030-01-01")), "order_id": F.lit(7)})
    found = monitor.recent_orders(shop.orders.unionByName(stranger), shop.users, n=3)
    by_id = {r["order_id"]: r for r in found.collect()}
    assert sorted(by_id) == [5, 6, 7]
    assert by_id[7]["name"] is None and by_id[6]["name"] == "Cyd"
    assert by_id[5]["order_time"] == "23:59:59" and by_id[5]["total"] == D("150.01")


def test_status_and_collections(shop):
    assert {r["status"]: r["order_count"] for r in monitor.status_distribution(shop.orders).collect()} == {
        "Completed": 5,
        "Cancelled": 1,
    }
    counts = monitor.collection_counts({"clicks": shop.clicks, "tickets": shop.tickets})
    assert {r["collection"]: r["documents"] for r in counts.collect()} == {"clicks": 4, "tickets": 3}


def test_minute_trend_skips_silent_minutes(spark):
    minutes = [0, 0, 1, 2, 2, 2, 5, 9]
    data = [(at(f"2024-01-01 10:0{m}:30"),) for m in minutes]
    events = spark.createDataFrame(data, "ts timestamp")
    found = rows(monitor.minute_trend(events, "ts", window=3), "minute")
    assert [(r["minute"].minute, r["orders"], r["moving_avg"]) for r in found] == [
        (0, 2, None),
        (1, 1, None),
        (2, 3, 2.0),
        (5, 1, 5 / 3),
        (9, 1, 5 / 3),
    ]
    recent = rows(monitor.minute_trend(events, "ts", window=3, within="5 minutes"), "minute")
    assert [r["minute"].minute for r in recent] == [5, 9]


@pytest.mark.parametrize(("ms", "label"), [(99.9, "good"), (100, "fair"), (499.9, "fair"), (500, "poor")])
def test_latency_class(spark, ms, label):
    assert spark.range(1).select(monitor.latency_class(F.lit(ms)).alias("v")).first()["v"] == label


def test_throughput_passes_above_four_fifths(spark):
    data = [(at("2024-01-01 10:00:01"),)] * 8 + [(at("2024-01-01 10:00:31"),)] * 9
    found = rows(monitor.throughput_scorecard(spark.createDataFrame(data, "ts timestamp"), "ts", 10 / 30), "step_start")
    assert [(r["events"], r["success_pct"], r["status"]) for r in found] == [(8, 80.0, "FAIL"), (9, 90.0, "PASS")]


def test_table_inventory(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(3).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    found = monitor.table_inventory(spark, {"t": spark.read.parquet(path), "gone": None})
    assert {r["table_name"]: (r["row_count"], r["byte_count"]) for r in found.collect()} == {"t": (100, size), "gone": (0, 0)}


def test_probes(shop):
    assert [r["order_id"] for r in monitor.latest_rows(shop.orders, "order_id", 2).collect()] == [6, 5]
    sample = monitor.order_line_sample(shop.orders, shop.items, 3).collect()
    assert [r["item_id"] for r in sample] == [1, 2, 3]
