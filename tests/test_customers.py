import datetime as dt
from decimal import Decimal as D

import pandas as pd
import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from stallbook.operators import customers


def purchases(spark, data):
    """Rows of (user, order, day, amount)."""
    full = [(u, o, at(d), D(a), d[:7], 1) for u, o, d, a in data]
    return spark.createDataFrame(
        full,
        "user_id int, order_id int, order_date timestamp, line_revenue decimal(18,2), order_month string, quantity bigint",
    )


def test_member_summary(shop):
    found = {r["member_level"]: r for r in customers.member_summary(shop.sales, shop.users).collect()}
    assert (found["Gold"]["total_customers"], found["Gold"]["total_orders"]) == (1, 4)  # rows, not orders
    assert found["Gold"]["avg_spent_per_user"] == 220.0
    assert found["Silver"]["total_spent"] == D("50.00")


def test_rfm_counts_orders_or_lines(shop):
    by_order = rows(customers.rfm_features(shop.sales), "user_id")
    assert [(r["recency"], r["frequency"], r["monetary"]) for r in by_order] == [(26, 2, D("220.00")), (0, 2, D("50.00"))]
    by_line = rows(customers.rfm_features(shop.sales, count_lines=True), "user_id")
    assert [r["frequency"] for r in by_line] == [4, 2]
    fixed = rows(customers.rfm_features(shop.sales, as_of=F.lit(dt.date(2024, 4, 1))), "user_id")
    assert [r["recency"] for r in fixed] == [49, 23]


@pytest.fixture(scope="module")
def clustered(spark):
    users = spark.range(60).select(
        F.col("id").cast("int").alias("user_id"),
        (F.col("id") % 3 * 100).cast("int").alias("recency"),
        (F.col("id") % 3 + 1).alias("frequency"),
        (F.col("id") % 3 * 1000 + F.col("id") / 10).cast("decimal(21,2)").alias("monetary"),
    )
    return customers.rfm_clusters(users, k=3).cache()


def test_clusters_cover_every_user_once(clustered):
    assert clustered.select("user_id").distinct().count() == clustered.count() == 60
    assert clustered.select("prediction").distinct().count() == 3
    profile = customers.cluster_profile(clustered).collect()
    assert sum(r["users"] for r in profile) == 60


def test_labels_follow_mean_spend(clustered):
    found = customers.rfm_segments(clustered, labels=("low", "middle", "high"))
    means = {r["customer_segment"]: r["m"] for r in found.groupBy("customer_segment").agg(F.avg("monetary").alias("m")).collect()}
    assert means["low"] < means["middle"] < means["high"]
    short = customers.rfm_segments(clustered, labels=("only",))
    assert {r[0] for r in short.select("customer_segment").distinct().collect()} == {"only", "Segment 2", "Segment 3"}


def test_clusters_are_repeatable(spark, clustered):
    users = clustered.select("user_id", "recency", "frequency", "monetary")
    again = customers.rfm_clusters(users.orderBy(F.rand(1)), k=3)
    assert rows(again.select("user_id", "prediction"), "user_id") == rows(clustered.select("user_id", "prediction"), "user_id")


@pytest.mark.parametrize("count", [0, 1, 2, 3])
def test_fewer_users_than_clusters(spark, count):
    few = spark.range(count).selectExpr("id AS user_id", "id AS recency", "1 AS frequency", "2.0D AS monetary")
    if count < 2:
        with pytest.raises(ValueError):
            customers.rfm_clusters(few, k=5)
        return
    found = customers.rfm_clusters(few, k=5)
    assert found.count() == count
    assert customers.rfm_segments(found).count() == count


def test_clusters_do_not_depend_on_the_session(spark):
    users = spark.range(400).selectExpr("id AS user_id", "id * 37 % 91 AS recency", "id * 11 % 13 AS frequency", "id * 7.5 % 1000 AS monetary")
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("3", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(rows(customers.rfm_clusters(users, k=5).select("user_id", "prediction"), "user_id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_cohorts(spark):
    sales = purchases(
        spark,
        [(1, 1, "2023-11-30", "1"), (1, 2, "2024-01-01", "1"), (1, 3, "2024-01-31", "1"), (2, 4, "2023-11-01", "1")],
    )
    found = rows(customers.cohort_retention(sales), "cohort_month", "months_since_first")
    assert [tuple(r.values()) for r in found] == [("2023-11", 0, 2), ("2023-11", 2, 1)]


def test_city_sales(shop):
    found = {r["city"]: r for r in customers.city_sales(shop.sales, shop.users).collect()}
    oslo = found["Oslo"]
    assert (oslo["total_customers"], oslo["total_orders"], oslo["avg_item_value"]) == (1, 2, 55.0)
    assert oslo["total_profit"] == D("114.00") and oslo["revenue_per_customer"] == 220.0


def test_lifetime_value(shop):
    found = rows(customers.clv(shop.sales, shop.users, tiers=(1000, 500, 100)), "user_id")
    ann = found[0]
    # 68 days old: 2 / (68 / 30) = 0.88 orders a month, 0.88 * 12 * 110 a year, 33 active days
    assert (ann["customer_age_days"], ann["active_days"], ann["purchase_frequency"]) == (68, 33, 0.88)
    assert ann["projected_annual_value"] == 1161.6
    assert ann["clv_score"] == round(1161.6 * (33 / 365 + 1), 2) and ann["clv_tier"] == "Platinum"
    assert found[1]["clv_tier"] == "Silver"  # 0.88 * 12 * 25 = 264, active for 25 days


def test_new_customers_count_as_one_month_old(shop):
    young = customers.clv(shop.sales, shop.users.withColumn("signup_date", F.lit(at("2024-03-09"))))
    assert rows(young, "user_id")[0]["purchase_frequency"] == 2.0


@pytest.fixture(scope="module")
def risks(spark):
    days = {1: 0, 2: 30, 3: 31, 4: 60, 5: 61, 6: 120, 7: 121}
    last = dt.date(2024, 6, 30)
    sales = purchases(spark, [(u, u, str(last - dt.timedelta(d)), "1") for u, d in days.items()])
    users = spark.range(1, 9).select(F.col("id").cast("int").alias("user_id"), F.lit("n").alias("name"))
    return customers.churn_risk(sales, users).cache()


def test_churn_limits(risks):
    found = [(r["days_since_last"], r["churn_risk"]) for r in rows(risks, "user_id")]
    assert found == [
        (0, "Active"),
        (30, "Active"),
        (31, "Dormant"),
        (60, "Dormant"),
        (61, "At Risk"),
        (120, "At Risk"),
        (121, "Churned"),
        (180, "New - No Purchase"),
    ]


def test_churn_tables(risks):
    summary = {r["churn_risk"]: (r["user_count"], r["avg_days_inactive"]) for r in customers.churn_summary(risks).collect()}
    assert summary["At Risk"] == (2, 90.5) and summary["New - No Purchase"] == (1, 180.0)
    counts = {r["churn_risk"]: r["user_count"] for r in customers.churn_distribution(risks).collect()}
    assert counts["Dormant"] == 2 and sum(counts.values()) == 8
    assert [r["user_id"] for r in customers.at_risk_top(risks, n=2).collect()] == [7, 6]


@pytest.mark.parametrize("values", [[0, 1, 2, 3, 10, 10], [5, 5, 5], [0, 0], [3, 60, 61, 7, 7, 30, 44], [-4, -4]])
def test_histogram_equals_pandas_cut(spark, values):
    churn = spark.createDataFrame([("Active", v) for v in values] + [("Churned", 999)], "churn_risk string, days_since_last int")
    got = rows(customers.inactivity_histogram(churn), "bin")
    got.sort(key=lambda r: r["bin"])
    expected = pd.cut(pd.Series(values, dtype="float"), bins=10).value_counts().sort_index()
    assert [r["user_count"] for r in got] == expected.tolist()
    assert [r["up_to"] for r in got] == pytest.approx([i.right for i in expected.index], abs=0.001)


def test_histogram_of_nothing_is_empty(risks):
    assert customers.inactivity_histogram(risks.filter("false")).collect() == []


def test_price_sensitivity_limits(spark):
    # mean line value and number of lines per user
    cases = {1: (999, 6), 2: (999, 5), 3: (3001, 3), 4: (3000, 3), 5: (5001, 6), 6: (5001, 4)}
    data = [(u, u * 10 + i, "2024-01-01", str(value)) for u, (value, n) in cases.items() for i in range(n)]
    found = {r["user_id"]: r["sensitivity_segment"] for r in customers.price_sensitivity(purchases(spark, data)).collect()}
    assert found == {
        1: "Price Sensitive - Frequent",
        2: "Average Shopper",
        3: "Quality Focused - Occasional",
        4: "Average Shopper",
        5: "Premium Loyal",
        6: "Average Shopper",
    }


def test_price_sensitivity_counts_lines_unless_told_otherwise(spark):
    sales = purchases(spark, [(1, 1, "2024-01-01", "10"), (1, 1, "2024-01-01", "20")])
    assert customers.price_sensitivity(sales).first()["total_orders"] == 2
    counted = customers.price_sensitivity(sales, count_orders=True).first()
    assert (counted["total_orders"], counted["avg_order_value"]) == (1, 15.0)
    stats = customers.sensitivity_stats(customers.price_sensitivity(sales)).first()
    assert (stats["count"], stats["avg_order_value"], stats["avg_orders"]) == (1, 15.0, 2.0)


def test_promoter_classes_and_score(spark):
    # (lines, amount per line): exactly at and just beyond the limits
    cases = {1: (8, "2500.01"), 2: (8, "2500.00"), 3: (4, "2000.01"), 4: (4, "2000.00"), 5: (9, "1.00")}
    data = [(u, u * 10 + i, "2024-01-01", a) for u, (n, a) in cases.items() for i in range(n)]
    users = customers.nps_users(purchases(spark, data))
    assert {r["user_id"]: r["nps_segment"] for r in users.collect()} == {
        1: "Promoter (9-10)",
        2: "Passive (7-8)",
        3: "Passive (7-8)",
        4: "Detractor (0-6)",
        5: "Detractor (0-6)",
    }
    classes = customers.nps_segments(users)
    assert sum(r["nps_contribution"] for r in classes.collect()) == pytest.approx(100, abs=0.2)
    assert customers.nps_score(classes).first()["nps_score"] == -20.0
    assert customers.nps_score(classes, reference_form=True).first()["nps_score"] == -60.0
    assert customers.nps_score(classes.limit(0)).first()["nps_score"] == 0.0
