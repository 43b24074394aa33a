import pytest
from conftest import rows

from stallbook import sources
from stallbook.operators import customers, finance
from stallbook.operators.sales import order_facts, order_rollup
from stallbook.plans.gold import SORT_KEYS, Bronze, Rules, build_gold, sorted_for_display
from stallbook.plans.staging import work_folder


@pytest.fixture(scope="module")
def build(shop):
    bronze = Bronze(
        items=shop.items,
        orders=shop.orders,
        products=shop.products,
        users=shop.users,
        returns=shop.returns,
        suppliers=shop.suppliers,
        purchase_orders=shop.purchase_orders,
        clicks=shop.clicks,
        tickets=shop.tickets,
    )
    return build_gold(bronze, Rules(stages=("view", "click", "buy"), min_support=0.5))


def test_every_gold_table_is_built(build):
    assert len(build.tables) == 35
    assert set(SORT_KEYS) <= set(build.tables)
    assert set(sources.SERVING_TABLES) <= set(build.tables)


def test_tables_read_the_staged_fact(spark, build):
    assert build.sales.count() == 6
    assert all(work_folder(spark) in name for name in build.sales.inputFiles())


@pytest.mark.parametrize(
    "table",
    {
        "monthly_pl": lambda s, shop: finance.monthly_pl(order_rollup(s), finance.monthly_refunds(shop.returns)),
        "weekly": lambda s, shop: finance.weekly_trend(s),
        "discount": lambda s, shop: finance.discount_roi(s),
        "payment": lambda s, shop: finance.payment_mix(s),
        "members": lambda s, shop: customers.member_summary(s, shop.users),
        "rfm": lambda s, shop: customers.rfm_features(s),
        "cohort": lambda s, shop: customers.cohort_retention(s),
        "city": lambda s, shop: customers.city_sales(s, shop.users),
        "clv": lambda s, shop: customers.clv(s, shop.users),
        "churn": lambda s, shop: customers.churn_risk(s, shop.users),
        "price": lambda s, shop: customers.price_sensitivity(s),
        "price by order": lambda s, shop: customers.price_sensitivity(s, count_orders=True),
        "nps": lambda s, shop: customers.nps_users(s),
        "nps by order": lambda s, shop: customers.nps_users(s, count_orders=True),
    }.items(),
    ids=lambda item: item[0],
)
def test_order_rows_give_the_same_tables_as_lines(shop, table):
    _, make = table
    from_lines, from_orders = make(shop.sales, shop), make(order_facts(shop.sales), shop)
    assert from_lines.columns == from_orders.columns
    assert sorted(map(str, from_lines.collect())) == sorted(map(str, from_orders.collect()))


def test_write_and_display(spark, build, tmp_path):
    names = build.write(lambda frame, name: sources.write_table(frame, name, path=str(tmp_path / name)))
    assert len(names) == 35
    counts = {name: spark.read.parquet(str(tmp_path / name)).count() for name in names}
    assert counts["gold_finance_pl"] == 3 and counts["gold_churn"] == 3 and counts["gold_inventory_v2"] == 5
    assert counts["gold_funnel"] == counts["gold_funnel_v2"] == counts["gold_daily_events"] == 3
    assert counts["gold_ml_rfm"] == counts["gold_rfm_v2"] == 2
    months = [r["order_month"] for r in sorted_for_display("gold_finance_pl", build.tables["gold_finance_pl"]).collect()]
    assert months == ["2024-01", "2024-02", "2024-03"]
    ranks = sorted_for_display("gold_category", build.tables["gold_category"]).collect()
    assert [r["category"] for r in ranks] == ["Home", "Tech", "Office"]


def test_columns_of_the_model_tables(build):
    assert build.tables["gold_ml_rfm"].columns == [
        "user_id",
        "recency_days",
        "frequency",
        "monetary_value",
        "customer_segment",
        "name",
        "email",
    ]
    journey = rows(build.tables["gold_journey"], "stage_no")
    assert [(r["stage"], r["count"]) for r in journey] == [("view", 2), ("click", 1), ("buy", 1)]
