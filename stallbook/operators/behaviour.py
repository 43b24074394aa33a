"""Clickstream, support, funnel and seasonality tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import half_up, ratio, sum_amount, weekday_name, weekday_number


def daily_event_funnel(clicks: DataFrame, when: str = "timestamp") -> DataFrame:
    """Events per day and type. Text timestamps that do not parse count under a NULL day."""
    day = F.try_to_timestamp(F.col(when)) if dict(clicks.dtypes)[when] == "string" else F.col(when)
    return clicks.groupBy(F.to_date(day).alias("event_date"), "event_type").agg(
        F.count("event_id").alias("event_count")
    )


def channel_attribution(clicks: DataFrame) -> DataFrame:
    """Events and distinct users per referrer."""
    return clicks.groupBy("referrer").agg(
        F.count("event_id").alias("total_events"), F.count_distinct("user_id").alias("unique_users")
    )


def device_breakdown(clicks: DataFrame) -> DataFrame:
    """Events per device and operating system."""
    return clicks.groupBy("device", "os").agg(F.count("event_id").alias("event_count"))


def support_summary(tickets: DataFrame) -> DataFrame:
    """Tickets and mean satisfaction per type and priority; missing scores are skipped."""
    score = F.col("satisfaction_score").cast("bigint")
    return tickets.groupBy("type", "priority").agg(
        F.count("ticket_id").alias("ticket_count"),
        ratio(F.sum(score), F.count(score)).alias("avg_satisfaction"),
    )


def weekday_hour_heatmap(
    facts: DataFrame, when: str = "order_date", amount: str = "line_revenue", key: str = "order_id"
) -> DataFrame:
    """Rows and revenue per weekday and hour."""
    return facts.groupBy(
        weekday_name(when).alias("day_of_week"), F.hour(when).alias("hour_of_day")
    ).agg(F.count(key).alias("order_count"), sum_amount(facts, amount).alias("total_revenue"))


def weekday_seasonality(facts: DataFrame, when: str = "order_date", amount: str = "line_revenue") -> DataFrame:
    """Revenue per weekday, Monday first by weekday_order."""
    return facts.groupBy(
        weekday_name(when).alias("weekday"), weekday_number(when).alias("weekday_order")
    ).agg(sum_amount(facts, amount).alias("total_revenue"))


def hour_seasonality(facts: DataFrame, when: str = "order_date", amount: str = "line_revenue") -> DataFrame:
    """Revenue per hour of day."""
    return facts.groupBy(F.hour(when).alias("hour")).agg(sum_amount(facts, amount).alias("total_revenue"))


def funnel_conversion(
    clicks: DataFrame, stages: Sequence[str], reference_form: bool = False
) -> DataFrame:
    """Events per funnel stage, conversion to the next stage and drop-off, in percent.

    All stages are counted in one pass into a single row, so the next stage is
    the next array element. ``reference_form`` divides a stage by the next one
    instead of the next one by the stage.
    """
    counted = clicks.agg(
        F.array(*(F.count_if(F.col("event_type") == stage) for stage in stages)).alias("counts")
    )
    names = F.array(*(F.lit(stage) for stage in stages))
    rows = counted.select(
        "counts", F.posexplode(F.arrays_zip(names.alias("stage"), F.col("counts").alias("count"))).alias("at", "row")
    ).select(
        (F.col("at") + 1).alias("stage_no"),
        F.col("row")["stage"].alias("stage"),
        F.col("row")["count"].alias("count"),
        F.get("counts", F.col("at") + 1).alias("following"),
    )
    part, whole = ("count", "following") if reference_form else ("following", "count")
    rate = half_up(ratio(part, whole) * F.lit(100.0), 1)
    return rows.select("stage_no", "stage", "count", rate.alias("conversion_rate")).withColumn(
        "dropoff_rate", half_up(F.lit(100.0) - F.col("conversion_rate"), 1)
    )


def dropoff_stages(funnel: DataFrame) -> DataFrame:
    """Stages that lose somebody."""
    return funnel.filter(F.col("dropoff_rate") > 0).select("stage", "dropoff_rate")
