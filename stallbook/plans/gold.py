"""The whole build: bronze inputs to every gold table, from one staged sales fact."""

from __future__ import annotations

from collections.abc import Callable, Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import behaviour, customers, finance, itemsets, products
from ..operators.sales import build_sales, order_facts, order_rollup
from ..sources.tables import write_all
from .staging import stage


@dataclass(frozen=True)
class Bronze:
    """Input tables with the columns of ``sources.schemas``."""

    items: DataFrame
    orders: DataFrame
    products: DataFrame
    users: DataFrame
    returns: DataFrame
    suppliers: DataFrame
    purchase_orders: DataFrame
    clicks: DataFrame
    tickets: DataFrame


@dataclass(frozen=True)
class Rules:
    """Business constants."""

    completed: str = "Completed"
    received: str = "Received"
    amount: Column | None = None
    as_of: Column | None = None
    churn_days: int = 60
    dormant_days: int = 30
    clv_tiers: tuple[float, float, float] = (50000, 20000, 5000)
    price_bounds: tuple[float, float, float] = (1000, 3000, 5000)
    price_counts: tuple[int, int] = (5, 3)
    promoter: tuple[int, float] = (8, 20000)
    passive: tuple[int, float] = (4, 8000)
    stages: tuple[str, ...] = ("view", "click", "signup", "purchase")
    basket_by: str = "user_id"
    min_support: float = 0.01
    min_confidence: float = 0.1


# Display order of each table: columns, a leading minus sorts downwards.
SORT_KEYS = {
    "gold_sales_performance": ("-total_revenue",),
    "gold_daily_events": ("event_date", "event_type"),
    "gold_finance": ("order_date_only",),
    "gold_inventory": ("-total_revenue", "product_id"),
    "gold_members": ("member_level",),
    "gold_funnel": ("event_date", "event_type"),
    "gold_ml_association": ("-confidence", "antecedent", "consequent"),
    "gold_finance_pl": ("order_month",),
    "gold_category": ("-total_revenue",),
    "gold_inventory_v2": ("days_of_stock", "product_id"),
    "gold_cohort": ("cohort_month", "months_since_first"),
    "gold_returns": ("-return_count", "category", "brand", "reason"),
    "gold_return_rate": ("-return_rate_pct", "category"),
    "gold_supplier": ("-total_procurement_value", "supplier_id"),
    "gold_weekly_sales": ("week_start",),
    "gold_funnel_v2": ("event_date", "event_type"),
    "gold_channel": ("-total_events", "referrer"),
    "gold_device": ("-event_count", "device", "os"),
    "gold_support": ("-ticket_count", "type", "priority"),
    "gold_abc": ("revenue_rank",),
    "gold_brand": ("-total_revenue", "brand"),
    "gold_hourly": ("day_of_week", "hour_of_day"),
    "gold_payment": ("-total_revenue", "payment_method"),
    "gold_city": ("-total_revenue", "city"),
    "gold_clv": ("-clv_score", "user_id"),
    "gold_journey": ("stage_no",),
    "gold_affinity": ("-affinity_score", "cat1", "cat2"),
    "gold_seasonality_weekly": ("weekday_order",),
    "gold_seasonality_hour": ("hour",),
}


def sorted_for_display(name: str, frame: DataFrame) -> DataFrame:
    """The table in its display order. A global sort: use it on what is shown, not before a write."""
    keys = SORT_KEYS.get(name)
    if keys is None:
        return frame
    return frame.orderBy(*(F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys))


@dataclass
class GoldBuild:
    """The staged facts and the lazy gold tables."""

    sales: DataFrame
    orders: DataFrame
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def write(self, writer: Callable[[DataFrame, str], None]) -> list[str]:
        return write_all(self.tables, writer)


def build_gold(
    bronze: Bronze, rules: Rules = Rules(), include_ml: bool = True, only: Collection[str] | None = None
) -> GoldBuild:
    """Define every gold table, or only those named.

    The sales fact is written once, and from it one row per order. Tables about
    orders and users read the order rows, the others the columns they need of
    the fact. Tables stay lazy; only the two facts, the product ranking and the
    models run jobs here.
    """
    sales = stage(
        build_sales(
            bronze.items, bronze.orders, bronze.products, completed=rules.completed, amount=rules.amount
        ),
        "sales",
    )
    orders = stage(order_facts(sales), "orders")
    low, mid, high = rules.price_bounds
    many, few = rules.price_counts
    # one column of the order rows, read again by the tables that count days
    today = orders.agg(F.max("order_date")).scalar() if rules.as_of is None else rules.as_of
    rfm = customers.rfm_features(orders, today)
    daily_events = behaviour.daily_event_funnel(bronze.clicks)

    tables: dict[str, Callable[[], DataFrame]] = {
        "gold_sales_performance": lambda: finance.sales_by_category(sales),
        "gold_daily_events": lambda: daily_events,
        "gold_finance": lambda: finance.daily_finance(sales),
        "gold_inventory": lambda: products.product_performance(sales, bronze.products),
        "gold_members": lambda: customers.member_summary(orders, bronze.users),
        "gold_funnel": lambda: daily_events,
        "gold_finance_pl": lambda: finance.monthly_pl(order_rollup(orders), finance.monthly_refunds(bronze.returns)),
        "gold_category": lambda: finance.category_performance(sales),
        "gold_inventory_v2": lambda: products.inventory_health(sales, bronze.products, bronze.suppliers),
        "gold_cohort": lambda: customers.cohort_retention(orders),
        "gold_returns": lambda: products.returns_breakdown(bronze.returns, bronze.products),
        "gold_return_rate": lambda: products.return_rate(sales, bronze.returns, bronze.products),
        "gold_supplier": lambda: products.supplier_scorecard(bronze.purchase_orders, bronze.suppliers, rules.received),
        "gold_weekly_sales": lambda: finance.weekly_trend(orders),
        "gold_funnel_v2": lambda: daily_events,
        "gold_channel": lambda: behaviour.channel_attribution(bronze.clicks),
        "gold_device": lambda: behaviour.device_breakdown(bronze.clicks),
        "gold_support": lambda: behaviour.support_summary(bronze.tickets),
        "gold_abc": lambda: products.abc_pareto(sales, bronze.products),
        "gold_brand": lambda: products.brand_performance(sales, bronze.returns, bronze.products),
        "gold_discount": lambda: finance.discount_roi(orders),
        "gold_hourly": lambda: behaviour.weekday_hour_heatmap(sales),
        "gold_payment": lambda: finance.payment_mix(orders),
        "gold_city": lambda: customers.city_sales(orders, bronze.users),
        "gold_clv": lambda: customers.clv(orders, bronze.users, rules.clv_tiers, today),
        "gold_churn": lambda: customers.churn_risk(
            orders, bronze.users, rules.churn_days, rules.dormant_days, today
        ),
        "gold_price_sensitivity": lambda: customers.price_sensitivity(orders, low, mid, high, many, few),
        "gold_journey": lambda: behaviour.funnel_conversion(bronze.clicks, rules.stages),
        "gold_affinity": lambda: products.category_affinity(sales),
        "gold_nps": lambda: customers.nps_segments(customers.nps_users(orders, rules.promoter, rules.passive)),
        "gold_seasonality_weekly": lambda: behaviour.weekday_seasonality(orders, amount="revenue"),
        "gold_seasonality_hour": lambda: behaviour.hour_seasonality(orders, amount="revenue"),
    }
    if include_ml:
        lines_rfm = customers.rfm_features(orders, today, count_lines=True)
        contacts = bronze.users.select("user_id", "name", "email")

        def four_segments() -> DataFrame:
            found = customers.rfm_segments(customers.rfm_clusters(lines_rfm, k=4), contacts, customers.SEGMENTS_4)
            return found.drop("prediction").withColumnsRenamed({"recency": "recency_days", "monetary": "monetary_value"})

        tables["gold_ml_rfm"] = four_segments
        tables["gold_ml_association"] = lambda: itemsets.vertical_rules(
            sales, rules.basket_by, "name", rules.min_support, rules.min_confidence
        )
        tables["gold_rfm_v2"] = lambda: customers.rfm_segments(customers.rfm_clusters(rfm, k=5), bronze.users)
    wanted = {name: make() for name, make in tables.items() if only is None or name in only}
    return GoldBuild(sales, orders, wanted)
