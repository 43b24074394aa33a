"""Figures and chart data computed from finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import flag_count, half_up, ordinal_of, percent
from ..plans.shares import share_of_total

# Order of the risk labels on a colour scale.
RISK_ORDER = ("Active", "Dormant", "At Risk", "Churned")


def executive_kpis(monthly: DataFrame, churn: DataFrame) -> DataFrame:
    """Net revenue, gross profit, active users and churn rate in one row."""
    users = churn.agg(
        F.count(F.lit(1)).alias("users"),
        flag_count(F.col("churn_risk") == "Active").alias("active"),
        flag_count(F.col("churn_risk") == "Churned").alias("churned"),
    )
    # both figures come from one subquery over the churn table
    figures = users.select(
        F.struct(
            "active", F.coalesce(percent("churned", "users", 1), F.lit(0.0)).alias("churn_rate")
        ).alias("figures")
    ).scalar()
    return monthly.agg(
        F.coalesce(F.sum("net_revenue"), F.lit(0)).alias("net_revenue"),
        F.coalesce(F.sum("gross_profit"), F.lit(0)).alias("gross_profit"),
    ).select(
        "net_revenue",
        "gross_profit",
        figures["active"].alias("active_users"),
        figures["churn_rate"].alias("churn_rate_pct"),
    )


def revenue_series(monthly: DataFrame) -> DataFrame:
    """Net revenue per month, in order, missing values as 0."""
    return monthly.select("order_month", F.coalesce("net_revenue", F.lit(0)).alias("net_revenue")).orderBy(
        "order_month"
    )


def brand_share(brands: DataFrame) -> DataFrame:
    """Revenue and percentage of all revenue per brand."""
    totals = brands.groupBy("brand").agg(F.sum("total_revenue").alias("total_revenue"))
    return totals.withColumn(
        "share_pct", half_up(share_of_total("total_revenue") * F.lit(100.0), 2)
    )


def finance_points(monthly: DataFrame) -> DataFrame:
    """Month number, gross and net revenue. Numbering runs over one row per month."""
    by_month = Window.orderBy("order_month")
    return monthly.select(
        (F.row_number().over(by_month) - 1).alias("x"),
        F.coalesce("gross_revenue", F.lit(0)).alias("y"),
        F.coalesce("net_revenue", F.lit(0)).alias("z"),
        F.coalesce("gross_revenue", F.lit(0)).alias("color"),
    )


def churn_points(churn: DataFrame, rfm: DataFrame) -> DataFrame:
    """Recency, frequency, spend and risk code per user with a purchase.

    Give both tables the same order rows (``order_facts``, staged): the lines
    are then read once.
    """
    return churn.select("user_id", "name", "churn_risk").join(rfm, "user_id").select(
        F.col("name").alias("label"),
        F.col("recency").alias("x"),
        F.col("frequency").alias("y"),
        F.col("monetary").alias("z"),
        ordinal_of("churn_risk", RISK_ORDER).alias("color"),
    )


def rfm_points(rfm: DataFrame) -> DataFrame:
    """Recency, frequency and spend per user, coloured by spend."""
    return rfm.select(
        F.col("recency").alias("x"),
        F.col("frequency").alias("y"),
        F.col("monetary").alias("z"),
        F.col("monetary").alias("color"),
    )


def stock_points(inventory: DataFrame) -> DataFrame:
    """Cost, stock and price per product, coloured by stock."""
    return inventory.select(
        F.col("name").alias("label"),
        F.col("cost_price").alias("x"),
        F.col("stock_quantity").alias("y"),
        F.col("selling_price").alias("z"),
        F.col("stock_quantity").alias("color"),
    )


def stage_points(funnel: DataFrame) -> DataFrame:
    """Alphabetical code of the stage and its count. Coding runs over one row per stage."""
    by_name = Window.orderBy("stage")
    return funnel.select(
        (F.dense_rank().over(by_name) - 1).alias("x"),
        F.lit(1).alias("y"),
        F.col("count").alias("z"),
        F.col("count").alias("color"),
    )


def hour_points(hourly: DataFrame) -> DataFrame:
    """Hour, hour modulo seven and revenue."""
    return hourly.select(
        F.col("hour").alias("x"),
        (F.col("hour") % 7).alias("y"),
        F.col("total_revenue").alias("z"),
        F.col("total_revenue").alias("color"),
    )
