"""Monthly parts: a refresh rewrites the folders of its months only, and the tables equal a full build."""

import dataclasses
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stallbook.plans.gold import Bronze, Rules, build_gold
from stallbook.plans.monthly import MONTH, PARTS, TABLES, MonthlyGold

RULES = Rules(stages=("view", "click", "buy"), min_support=0.5)


@pytest.fixture(scope="module")
def bronze(shop):
    names = ("items", "orders", "products", "users", "returns", "suppliers", "purchase_orders", "clicks", "tickets")
    return Bronze(**{name: getattr(shop, name) for name in names})


def moved(bronze, **columns):
    return dataclasses.replace(bronze, orders=bronze.orders.withColumns(columns))


def files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def months_of(names):
    return {n.split(f"{MONTH}=")[1].split("/")[0] for n in names}


def same_tables(store, bronze):
    full = build_gold(bronze, RULES, include_ml=False, only=TABLES).tables
    for name in TABLES:
        got, want = store.table(name, bronze), full[name]
        assert got.columns == want.columns
        assert sorted(map(str, rows(got))) == sorted(map(str, rows(want))), name


def test_full_build_and_refreshes(spark, bronze, tmp_path):
    store = MonthlyGold(spark, str(tmp_path), RULES)
    store.refresh(bronze)
    same_tables(store, bronze)
    first = files(tmp_path)
    months = sorted(months_of(first))
    assert len(months) > 1 and {n.split("/")[0] for n in first} == set(PARTS)

    # one month's orders change: only its folders do
    one = months[0]
    changed = moved(bronze, discount_amount=(F.col("discount_amount") + F.when(F.date_format("order_date", "yyyy-MM") == one, 1).otherwise(0)).cast("decimal(8,2)"))
    store.refresh(changed, [one])
    second = files(tmp_path)
    assert months_of(first ^ second) == {one}
    same_tables(store, changed)

    # its orders go to a month of their own: the old month's folders go
    gone = moved(changed, order_date=F.when(F.date_format("order_date", "yyyy-MM") == one, F.lit("2031-02-03").cast("timestamp")).otherwise(F.col("order_date")))
    gone = dataclasses.replace(gone, returns=bronze.returns.limit(0))
    store.refresh(gone, [one, "2031-02", *months])
    assert one not in months_of(files(tmp_path)) and "2031-02" in months_of(files(tmp_path))
    same_tables(store, gone)


def test_a_month_without_sales_is_no_error(spark, bronze, tmp_path):
    store = MonthlyGold(spark, str(tmp_path), RULES, ["gold_finance"])
    store.refresh(bronze)
    before = files(tmp_path)
    assert {n.split("/")[0] for n in before} == {"fact", "days"}
    store.refresh(bronze, ["1900-01"])
    assert files(tmp_path) == before


def test_lines_of_other_months_are_not_read(spark, bronze, tmp_path):
    store = MonthlyGold(spark, str(tmp_path), RULES, ["gold_finance"])
    store.refresh(bronze)
    (month, *_) = sorted(months_of(files(tmp_path)))
    plan = store._stored("fact", [month])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and month in plan.split("PartitionFilters: [")[1].split("]")[0]
