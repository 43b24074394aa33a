"""Operational tables: sizes, live figures, recent orders, throughput."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_column, band, half_up, ratio, sum_amount, time_of_day
from ..plans.ranking import moving_average

# Latency classes in milliseconds and the pass mark of a load step.
LATENCY_BANDS = ((100, "good"), (500, "fair"))
LATENCY_ABOVE = "poor"
PASS_MARK = 0.8


def table_inventory(spark: SparkSession, tables: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows and bytes per file-backed table; a missing table has none of either."""

    def one(name: str, frame: DataFrame | None) -> DataFrame:
        if frame is None:
            return spark.range(1).select(
                F.lit(name).alias("table_name"),
                F.lit(0).cast("bigint").alias("row_count"),
                F.lit(0).cast("bigint").alias("byte_count"),
            )
        files = (
            frame.select("_metadata.file_path", "_metadata.file_size")
            .groupBy("file_path")
            .agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("bytes"))
        )
        return files.agg(
            F.lit(name).alias("table_name"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("row_count"),
            F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("byte_count"),
        ).select("table_name", "row_count", "byte_count")

    return reduce(DataFrame.unionByName, (one(name, frame) for name, frame in tables.items()))


def collection_counts(collections: Mapping[str, DataFrame]) -> DataFrame:
    """Documents per collection."""
    counts = (
        frame.agg(F.lit(name).alias("collection"), F.count(F.lit(1)).alias("documents"))
        for name, frame in collections.items()
    )
    return reduce(DataFrame.unionByName, counts)


def live_kpis(
    orders: DataFrame,
    when: str = "order_date",
    user: str = "user_id",
    amount: Column | str = "amount",
    as_of: Column | None = None,
) -> DataFrame:
    """Totals, last hour, last five minutes, last day, customers and mean amount in one pass.

    ``as_of`` is the time the intervals end at; by default the newest row.
    """
    now = orders.agg(F.max(when)).scalar() if as_of is None else as_of

    def last(interval: str) -> Column:
        return F.col(when) > now - F.expr(f"INTERVAL {interval}")

    valued = orders.select(when, user, as_column(amount).alias("_amount"))
    figures = valued.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(last("1 HOUR")).alias("hourly_orders"),
        F.count_if(last("5 MINUTES")).alias("min5_orders"),
        F.max(F.when(last("1 HOUR"), F.col(when))).alias("last_order"),
        F.coalesce(sum_amount(valued, "_amount", last("24 HOURS")), F.lit(0)).alias("daily_revenue"),
        F.count_distinct(user).alias("unique_customers"),
        F.coalesce(ratio(sum_amount(valued, "_amount"), F.count("_amount")), F.lit(0.0)).alias("avg_order_value"),
    )
    return figures.withColumn("tx_per_sec", ratio("min5_orders", F.lit(300)))


def recent_orders(orders: DataFrame, users: DataFrame, n: int = 10, total: Column | None = None) -> DataFrame:
    """The n newest orders with the customer's name; ties by order_id, newest number first.

    The orders are cut to n before the join, and only the users of those n are
    looked up, so the hint below covers at most n rows.
    """
    amount = F.col("shipping_fee") + F.col("discount_amount") if total is None else total
    newest = (
        orders.select("order_id", "user_id", "order_date", "status", amount.alias("total"))
        .orderBy(F.desc("order_date"), F.desc("order_id"))
        .limit(n)
    )
    names = users.select("user_id", "name").join(F.broadcast(newest.select("user_id").distinct()), "user_id", "left_semi")
    return newest.join(names, "user_id", "left").select(
        "order_id", "order_date", time_of_day("order_date").alias("order_time"), "name", "status", "total"
    )


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per status."""
    return orders.groupBy("status").agg(F.count(F.lit(1)).alias("order_count"))


def per_minute(rows: DataFrame, when: str, within: str | None = None, as_of: Column | None = None) -> DataFrame:
    """Rows per minute, optionally of the last interval only."""
    if within is not None:
        now = rows.agg(F.max(when)).scalar() if as_of is None else as_of
        rows = rows.filter(F.col(when) > now - F.expr(f"INTERVAL {within}"))
    return (
        rows.groupBy(F.window(when, "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .select(F.col("w.start").alias("minute"), "orders")
    )


def minute_trend(
    rows: DataFrame,
    when: str,
    window: int = 5,
    within: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Rows per minute with the mean of the last ``window`` minutes that have any. Runs one job."""
    minutes = per_minute(rows, when, within, as_of)
    return moving_average(minutes, [F.asc("minute")], "orders", window, "moving_avg")


def latency_class(milliseconds: Column | str) -> Column:
    return band(milliseconds, LATENCY_BANDS, LATENCY_ABOVE, inclusive=False)


def rated(steps: DataFrame, target: float, seconds: Column) -> DataFrame:
    """The steps with their rate of ``events`` a second, its share of the target, and PASS or FAIL."""
    rates = steps.select("*", F.lit(float(target)).alias("target_rate"), ratio("events", seconds).alias("actual_rate"))
    achieved = ratio("actual_rate", "target_rate")
    return rates.select(
        "*",
        half_up(achieved * F.lit(100.0), 1).alias("success_pct"),
        F.when(achieved > F.lit(PASS_MARK), "PASS").otherwise("FAIL").alias("status"),
    )


def throughput_scorecard(
    events: DataFrame, when: str, target: float, step: str = "30 seconds", step_seconds: int = 30
) -> DataFrame:
    """Events, true rate and PASS or FAIL against a target rate, per time step."""
    steps = events.groupBy(F.window(when, step).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return rated(steps.select(F.col("w.start").alias("step_start"), "events"), target, F.lit(step_seconds))


def event_types(events: DataFrame) -> DataFrame:
    """Events per type; a missing type counts as unknown."""
    named = events.select(F.coalesce("event_type", F.lit("unknown")).alias("event_type"))
    return named.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def latest_rows(table: DataFrame, by: str, n: int = 100) -> DataFrame:
    """The n rows with the highest key (a probe query; the key must be unique)."""
    return table.orderBy(F.desc(by)).limit(n)


def order_line_sample(orders: DataFrame, items: DataFrame, n: int = 100) -> DataFrame:
    """n joined order lines (a probe query), the same ones in every run.

    The order is on columns of the lines, and each line has its order by the
    source's foreign key, so the lines are cut to n before they meet the orders.
    """
    first = items.orderBy(*items.columns).limit(n)
    return orders.join(first, "order_id").orderBy(*items.columns)
