"""Every registered query against its SQL on a small data set."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract
from stallbook.plans import oracle, registry
from tools.compare import compare, database

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not available")

QUERIES, SQL = registry.queries(), oracle.statements()

# with few users a support of one percent is one user, and every subset of a basket is frequent
NEEDS_LARGER = {"association_rules", "vertical_rules"}

# cluster numbers and file sizes have no SQL; clusters_of_* and table_rows check what must hold for them
WITHOUT_SQL = {"rfm_segments", "rfm_segments_four", "cluster_profile", "table_inventory"}


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    folder, base = (LARGER, database(LARGER)) if name in NEEDS_LARGER else (FOLDER, con)
    good, note = compare(spark, base, folder, name, QUERIES[name], SQL.get(name))
    assert good, note


@pytest.mark.parametrize(
    "name",
    ["monthly_pl", "inventory_health", "brand_performance", "supplier_scorecard", "clv", "enriched_clicks", "recent_orders"],
)
def test_results_do_not_depend_on_the_join_strategy(spark, con, name):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for setting in settings:
        spark.conf.set(setting, "-1")
    try:
        good, note = compare(spark, con, FOLDER, name, QUERIES[name], SQL[name])
    finally:
        for setting in settings:
            spark.conf.unset(setting)
    assert good, note


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and frame.columns[0] == "order_month"
