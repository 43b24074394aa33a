"""The sales fact and the two aggregates most tables start from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import iso_week, money, month_key, ratio, sum_money


def build_lines(
    items: DataFrame,
    orders: DataFrame,
    *,
    completed: str = "Completed",
    amount: Column | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """One row per line of a completed order, without product attributes.

    Enough for every table about users, orders or product numbers. With
    ``products`` it has the rows of ``build_sales``: a line that names no
    existing product is left out. Leave it away only where the source enforces
    the foreign key; it then spares a join.

    ``amount`` is the line revenue; by default quantity times unit price. The
    status filter reaches the order scan.
    """
    revenue = money(F.col("quantity") * F.col("unit_price") if amount is None else amount)
    headers = orders.filter(F.col("status") == completed).select(
        "order_id", "user_id", "order_date", "payment_method", "shipping_fee", "discount_amount"
    )
    if products is not None:
        items = items.join(products.select("product_id"), "product_id", "left_semi")
    return items.join(headers, "order_id").select(
        "order_id",
        "product_id",
        "user_id",
        "order_date",
        "payment_method",
        "shipping_fee",
        "discount_amount",
        F.col("quantity").cast("bigint").alias("quantity"),
        revenue.alias("line_revenue"),
        month_key("order_date").alias("order_month"),
        iso_week("order_date").alias("order_week"),
    )


def build_sales(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    *,
    completed: str = "Completed",
    amount: Column | None = None,
) -> DataFrame:
    """The sales fact: lines of completed orders with product attributes, cost and profit.

    Lines meet the reduced order table first and products last. Neither join is
    hinted: Spark broadcasts a side whose measured size allows it and otherwise
    sorts and merges, where the adaptive plan splits a hot product.
    """
    attributes = products.select("product_id", "brand", "name", "category", "cost_price")
    cost = money(F.col("quantity") * F.col("cost_price"))
    return (
        build_lines(items, orders, completed=completed, amount=amount)
        .join(attributes, "product_id")
        .withColumn("line_cost", cost)
        .withColumn("line_profit", money(F.col("line_revenue") - F.col("line_cost")))
        .drop("cost_price")
    )


def order_facts(sales: DataFrame) -> DataFrame:
    """One row per order: sums over its lines, and what all its lines share.

    Tables about orders, users, weeks, discounts and payments accept this frame
    in place of the lines. Written once, it spares each of them a shuffle of all
    lines. Shared values repeat on every line of an order, so any value does;
    max makes the choice the same in every run.
    """
    shared = ("order_date", "payment_method", "shipping_fee", "discount_amount")
    costs = [sum_money("line_cost").alias("cost")] if "line_cost" in sales.columns else []
    return sales.groupBy("order_id", "user_id").agg(
        sum_money("line_revenue").alias("revenue"),
        *costs,
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("lines"),
        *(F.max(column).alias(column) for column in shared),
    )


def _is_order_level(sales: DataFrame) -> bool:
    return "lines" in sales.columns


def sums_by_order(sales: DataFrame, *keys: str) -> DataFrame:
    """Order-level sums within further keys; cost only where the fact carries it.

    Rows are spread by order as well as by key, so a key that owns a third of
    all lines is still spread over all tasks. The next level then counts orders
    as rows, which spares a distinct count.
    """
    if _is_order_level(sales):
        return sales
    costs = [sum_money("line_cost").alias("cost")] if "line_cost" in sales.columns else []
    return sales.groupBy("order_id", "user_id", *keys).agg(
        sum_money("line_revenue").alias("revenue"),
        *costs,
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("lines"),
        F.max("order_date").alias("order_date"),
    )


def sums_by_user(sales: DataFrame) -> DataFrame:
    """User-level sums, order and line counts, first and last purchase."""
    per_order = sums_by_order(sales)
    costs = [F.sum("cost").alias("cost")] if "cost" in per_order.columns else []
    return (
        per_order.groupBy("user_id")
        .agg(
            F.sum("revenue").alias("revenue"),
            *costs,
            F.count(F.lit(1)).alias("orders"),
            F.sum("lines").alias("lines"),
            F.min("order_date").alias("first_purchase"),
            F.max("order_date").alias("last_purchase"),
        )
    )


def spend_by_user(sales: DataFrame) -> DataFrame:
    """Revenue, lines and units per user: straight from the lines, or from order facts."""
    users = sales.groupBy("user_id")
    if _is_order_level(sales):
        return users.agg(
            F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"), F.sum("units").alias("units")
        )
    return users.agg(
        sum_money("line_revenue").alias("revenue"),
        F.count("order_id").alias("lines"),
        F.sum("quantity").alias("units"),
    )


def order_rollup(sales: DataFrame) -> DataFrame:
    """Revenue, cost, shipping and discount per order, with its month."""
    orders = sales if _is_order_level(sales) else order_facts(sales)
    return orders.select(
        "order_id",
        month_key("order_date").alias("order_month"),
        "order_date",
        F.col("revenue").alias("order_revenue"),
        F.col("cost").alias("order_cost"),
        "shipping_fee",
        "discount_amount",
    )


def flatten_clicks(
    clicks: DataFrame,
    fields: Mapping[str, tuple[str, str]] | None = None,
    drop: Sequence[str] = ("metadata", "_id"),
) -> DataFrame:
    """Lift members of ``metadata`` to columns; ``fields`` maps new column to (member, type)."""
    chosen = fields or {"url": ("url", "string"), "duration_sec": ("session_duration_sec", "int")}
    lifted = {
        column: F.col(f"metadata.{member}").try_cast(kind) for column, (member, kind) in chosen.items()
    }
    return clicks.withColumns(lifted).drop(*drop)


def enrich_clicks(clicks: DataFrame, users: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Clicks with user attributes; clicks of unknown users stay."""
    wanted = users if columns is None else users.select("user_id", *columns)
    return clicks.join(wanted, "user_id", "left")


def average_dwell(enriched: DataFrame, by: str = "city", duration: str = "duration_sec") -> DataFrame:
    """Events and mean seconds per value of a user attribute."""
    return enriched.groupBy(by).agg(
        F.count("event_id").alias("events"),
        ratio(F.sum(F.col(duration).cast("bigint")), F.count(duration)).alias("avg_dwell_sec"),
    )
