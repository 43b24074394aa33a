"""Revenue, profit and loss, discounts, payments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import band, half_up, month_key, percent, ratio, sum_amount, sum_money, week_start
from ..plans.shares import share_of_total
from .sales import sums_by_order

# Discount bands and their labels.
DISCOUNT_BANDS = ((0, "No Discount"), (50, "$1-50"), (100, "$51-100"), (150, "$101-150"))
DISCOUNT_ABOVE = "$150+"


def sales_by_category(sales: DataFrame, key: str = "category", amount: str = "line_revenue") -> DataFrame:
    """Revenue and number of sales rows per category."""
    return sales.groupBy(key).agg(
        sum_amount(sales, amount).alias("total_revenue"), F.count("order_id").alias("total_orders")
    )


def daily_finance(sales: DataFrame) -> DataFrame:
    """Revenue, cost and gross profit per day; daily_orders counts sales rows."""
    daily = sales.groupBy(F.to_date("order_date").alias("order_date_only")).agg(
        sum_money("line_revenue").alias("daily_revenue"),
        sum_money("line_cost").alias("daily_cost"),
        F.count("order_id").alias("daily_orders"),
    )
    return daily.select(
        "order_date_only",
        "daily_revenue",
        "daily_cost",
        (F.col("daily_revenue") - F.col("daily_cost")).alias("daily_gross_profit"),
        "daily_orders",
    )


def monthly_refunds(returns: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Refunds per month of return; every status counts unless some are named."""
    counted = returns if statuses is None else returns.filter(F.col("status").isin(*statuses))
    return counted.groupBy(month_key("return_date").alias("return_month")).agg(
        sum_money("refund_amount").alias("total_refunds")
    )


def monthly_pl(order_level: DataFrame, refunds: DataFrame) -> DataFrame:
    """Monthly profit and loss from order rollups.

    Net is gross less discounts and refunds; gross profit is net less cost of
    goods. Shipping is reported only. Refunds of a month without sales are left
    out.
    """
    refunded = refunds.select(F.col("return_month").alias("order_month"), "total_refunds")
    given_back = F.coalesce(F.col("total_refunds"), F.lit(0).cast(refunds.schema["total_refunds"].dataType))
    net = F.col("gross") - F.col("discounts") - given_back
    return (
        order_level.groupBy("order_month")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum("order_revenue").alias("gross"),
            F.sum("order_cost").alias("cogs"),
            sum_money("discount_amount").alias("discounts"),
            sum_money("shipping_fee").alias("shipping"),
        )
        .join(refunded, "order_month", "left")
        .select(
            "order_month",
            F.col("gross").alias("gross_revenue"),
            F.col("cogs").alias("total_cogs"),
            F.col("discounts").alias("total_discounts"),
            given_back.alias("total_refunds"),
            F.col("shipping").alias("total_shipping"),
            net.alias("net_revenue"),
            (net - F.col("cogs")).alias("gross_profit"),
            percent(net - F.col("cogs"), net, 1).alias("gross_margin_pct"),
            "total_orders",
        )
    )


def category_performance(sales: DataFrame, approx: bool = False) -> DataFrame:
    """Revenue, cost, profit, units, orders and products per category.

    Lines are summed per (category, product) and orders counted as rows per
    (category, order); the two small results meet on the category. So neither
    distinct count expands the lines, and a category that owns a third of them
    is still spread by product and by order. ``approx`` counts orders by a
    sketch instead, which spares the second pass.
    """
    per_product = sales.groupBy("category", "product_id").agg(
        sum_money("line_revenue").alias("revenue"),
        sum_money("line_cost").alias("cost"),
        F.sum("quantity").alias("units"),
        *([F.hll_sketch_agg("order_id").alias("orders")] if approx else []),
    )
    totals = per_product.groupBy("category").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("cost").alias("total_cost"),
        F.sum("units").alias("total_units_sold"),
        F.count("product_id").alias("product_count"),
        *([F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("total_orders")] if approx else []),
    )
    orders = (
        sales.select("category", "order_id").distinct()
        .groupBy("category").agg(F.count("order_id").alias("total_orders"))
        .withColumnRenamed("category", "of_category")
    )
    if not approx:
        totals = totals.join(orders, F.col("category").eqNullSafe(F.col("of_category")))
    return category_figures(totals)


def category_figures(totals: DataFrame) -> DataFrame:
    """Profit, margin and order value of the totals per category."""
    profit = F.col("total_revenue") - F.col("total_cost")
    return totals.select(
        "category",
        "total_revenue",
        "total_cost",
        profit.alias("total_profit"),
        "total_units_sold",
        "total_orders",
        "product_count",
        percent(profit, "total_revenue", 1).alias("profit_margin_pct"),
        half_up(ratio("total_revenue", "total_orders"), 2).alias("avg_order_value"),
    )


def weekly_trend(sales: DataFrame) -> DataFrame:
    """Revenue, profit, units, orders and active users per Monday week."""
    per_order = sums_by_order(sales).withColumn("week_start", week_start("order_date"))
    return per_order.groupBy("week_start").agg(
        F.sum("revenue").alias("weekly_revenue"),
        (F.sum("revenue") - F.sum("cost")).alias("weekly_profit"),
        F.sum("units").alias("weekly_units"),
        F.count(F.lit(1)).alias("weekly_orders"),
        F.count_distinct("user_id").alias("weekly_active_users"),
    )


def discount_roi(
    sales: DataFrame,
    bands: Sequence[tuple[float, str]] = DISCOUNT_BANDS,
    above: str = DISCOUNT_ABOVE,
) -> DataFrame:
    """Orders, revenue and profit per discount band, and revenue per unit of discount."""
    per_order = sums_by_order(sales, "discount_amount")
    grouped = per_order.groupBy(band("discount_amount", bands, above).alias("discount_band")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("revenue").alias("total_revenue"),
        (F.sum("revenue") - F.sum("cost")).alias("total_profit"),
        F.sum("units").alias("units"),
        sum_money("discount_amount").alias("total_discount_given"),
    )
    return grouped.select(
        "discount_band",
        "order_count",
        half_up(ratio("total_revenue", "order_count"), 2).alias("avg_order_value"),
        half_up(ratio("units", "order_count"), 1).alias("avg_items_per_order"),
        "total_revenue",
        "total_profit",
        "total_discount_given",
        half_up(ratio("total_revenue", F.greatest("total_discount_given", F.lit(1))), 2).alias("discount_roi"),
    )


def payment_mix(sales: DataFrame) -> DataFrame:
    """Orders, revenue, mean line value, users and revenue share per payment method.

    The share is rounded to two places before it becomes a percentage.
    """
    methods = (
        sums_by_order(sales, "payment_method")
        .groupBy("payment_method")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("lines").alias("lines"),
            F.count_distinct("user_id").alias("unique_users"),
        )
    )
    return payment_figures(methods)


def payment_figures(methods: DataFrame) -> DataFrame:
    """Mean line value and revenue share of the totals per payment method."""
    return methods.select(
        "payment_method",
        "total_orders",
        "total_revenue",
        half_up(ratio("total_revenue", "lines"), 2).alias("avg_line_value"),
        "unique_users",
        (half_up(share_of_total("total_revenue"), 2) * F.lit(100.0)).alias("revenue_share_pct"),
    )
