from decimal import Decimal as D

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stallbook.operators import finance
from stallbook.operators.sales import (
    average_dwell,
    build_lines,
    build_sales,
    enrich_clicks,
    flatten_clicks,
    order_rollup,
    sums_by_user,
)


def test_fact_keeps_lines_of_completed_orders_only(shop):
    found = rows(shop.sales, "order_id", "product_id")
    assert [(r["order_id"], r["product_id"], r["line_revenue"], r["line_cost"], r["line_profit"]) for r in found] == [
        (1, 1, D("10.00"), D("4.00"), D("6.00")),
        (1, 2, D("80.00"), D("50.00"), D("30.00")),
        (2, 2, D("80.00"), D("50.00"), D("30.00")),
        (2, 4, D("50.00"), D("2.00"), D("48.00")),
        (3, 3, D("50.00"), D("20.00"), D("30.00")),
        (5, 1, D("0.00"), D("2.00"), D("-2.00")),
    ]
    assert found[0]["order_month"] == "2024-01" and found[0]["order_week"] == "2024-W02"


def test_lines_are_the_fact_without_product_columns(shop):
    lines = build_lines(shop.items, shop.orders)
    shared = lines.columns
    assert rows(lines, "order_id", "product_id") == rows(shop.sales.select(*shared), "order_id", "product_id")


def test_amount_may_be_given(shop):
    fixed = build_sales(shop.items, shop.orders, shop.products, amount=F.lit(1))
    assert fixed.agg(F.sum("line_revenue")).first()[0] == D("6.00")


def test_order_rollup_has_one_row_per_order(shop):
    found = rows(order_rollup(shop.sales), "order_id")
    assert [(r["order_id"], r["order_revenue"], r["shipping_fee"], r["discount_amount"]) for r in found] == [
        (1, D("90.00"), D("60.00"), D("0.00")),
        (2, D("130.00"), D("0.00"), D("50.00")),
        (3, D("50.00"), D("0.00"), D("100.01")),
        (5, D("0.00"), D("0.00"), D("150.01")),
    ]


def test_user_sums(shop):
    first = rows(sums_by_user(shop.sales), "user_id")[0]
    assert (first["revenue"], first["orders"], first["lines"]) == (D("220.00"), 2, 4)


def test_flatten_casts_and_drops(shop):
    fields = {"duration_sec": ("session_duration_sec", "int"), "query": ("search_query", "string")}
    flat = flatten_clicks(shop.clicks, fields)
    assert "metadata" not in flat.columns
    assert [r["duration_sec"] for r in rows(flat, "event_id")] == [30, 50, None, None]


def test_enrichment_keeps_clicks_of_unknown_users(shop):
    flat = flatten_clicks(shop.clicks, {"duration_sec": ("session_duration_sec", "int")})
    joined = enrich_clicks(flat, shop.users, ["city"])
    assert joined.count() == 4
    dwell = {r["city"]: (r["events"], r["avg_dwell_sec"]) for r in average_dwell(joined).collect()}
    assert dwell == {"Oslo": (2, 40.0), "Rome": (1, None), None: (1, None)}


def test_sales_by_category_and_day(shop):
    found = {r["category"]: (r["total_revenue"], r["total_orders"]) for r in finance.sales_by_category(shop.sales).collect()}
    assert found == {"Office": (D("10.00"), 2), "Home": (D("210.00"), 3), "Tech": (D("50.00"), 1)}
    daily = rows(finance.daily_finance(shop.sales), "order_date_only")
    assert daily[0]["daily_gross_profit"] == D("36.00") and daily[0]["daily_orders"] == 2  # rows, not orders


def test_profit_and_loss(shop):
    pl = finance.monthly_pl(order_rollup(shop.sales), finance.monthly_refunds(shop.returns))
    found = {r["order_month"]: r for r in rows(pl)}
    assert sorted(found) == ["2024-01", "2024-02", "2024-03"]  # the refund of 2025-07 is left out
    january = found["2024-01"]
    assert (january["gross_revenue"], january["total_refunds"], january["net_revenue"]) == (
        D("90.00"),
        D("5.00"),
        D("85.00"),
    )
    assert january["gross_profit"] == D("31.00") and january["gross_margin_pct"] == 36.5
    february = found["2024-02"]
    assert february["total_refunds"] == D("120.00")  # pending refunds count
    assert february["total_orders"] == 2 and february["total_discounts"] == D("150.01")
    assert found["2024-03"]["total_refunds"] == 0


def test_refunds_by_status(shop):
    found = {r["return_month"]: r["total_refunds"] for r in finance.monthly_refunds(shop.returns, ["Approved"]).collect()}
    assert found == {"2024-01": D("5.00"), "2024-02": D("40.00"), "2025-07": D("25.00")}


def test_margin_of_zero_revenue_is_null(spark):
    level = spark.createDataFrame(
        [(1, "2024-01", D("0.00"), D("0.00"), D("0.00"), D("0.00"))],
        "order_id int, order_month string, order_revenue decimal(21,2), order_cost decimal(21,2), "
        "shipping_fee decimal(8,2), discount_amount decimal(8,2)",
    )
    refunds = spark.createDataFrame([], "return_month string, total_refunds decimal(21,2)")
    assert finance.monthly_pl(level, refunds).first()["gross_margin_pct"] is None


@pytest.mark.parametrize("approx", [False, True])
def test_category_performance(shop, approx):
    home = {r["category"]: r for r in finance.category_performance(shop.sales, approx).collect()}["Home"]
    assert (home["total_orders"], home["product_count"], home["total_units_sold"]) == (3, 2, 4)
    assert home["total_profit"] == D("90.00") and home["profit_margin_pct"] == 42.9 and home["avg_order_value"] == 70.0


def test_weekly_trend(shop):
    found = {str(r["week_start"]): r for r in finance.weekly_trend(shop.sales).collect()}
    week = found["2024-02-12"]
    assert (week["weekly_orders"], week["weekly_active_users"], week["weekly_units"]) == (2, 2, 5)
    assert week["weekly_revenue"] == D("180.00") and week["weekly_profit"] == D("108.00")


def test_discount_bands_and_roi(shop):
    found = {r["discount_band"]: r for r in finance.discount_roi(shop.sales).collect()}
    assert sorted(found) == ["$1-50", "$101-150", "$150+", "No Discount"]
    assert found["No Discount"]["discount_roi"] == 90.0  # divided by one, not by zero
    assert found["$1-50"]["discount_roi"] == 2.6
    assert found["$1-50"]["avg_items_per_order"] == 3.0


def test_payment_share_is_rounded_before_it_becomes_a_percentage(shop):
    found = {r["payment_method"]: r for r in finance.payment_mix(shop.sales).collect()}
    assert (found["card"]["revenue_share_pct"], found["cash"]["revenue_share_pct"]) == (81.0, 19.0)
    assert (found["cash"]["total_orders"], found["cash"]["unique_users"]) == (2, 1)
    assert found["card"]["avg_line_value"] == 55.0


def test_lines_without_a_product_follow_one_rule(spark, shop):
    orphan = spark.createDataFrame([(99, 1, 999, 1, D("7.00"))], shop.items.schema)
    items = shop.items.unionByName(orphan)
    fact = build_sales(items, shop.orders, shop.products)
    lean = build_lines(items, shop.orders, products=shop.products)
    assert rows(lean.select("order_id", "product_id"), "order_id", "product_id") == rows(
        fact.select("order_id", "product_id"), "order_id", "product_id"
    )
    assert build_lines(items, shop.orders).count() == fact.count() + 1
