"""The physical plans that matter at scale."""

import re
from pathlib import Path

import pytest

from stallbook.plans import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not available")

# what a gold query returns is read back from files: its plan says nothing
QUERIES = {name: q for name, q in registry.queries().items() if name not in registry.GOLD_TABLES}


def plan(spark, name):
    """The plan before it is adapted, with broadcast joins switched off as for large tables."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows_or_runs_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups", text)


def test_a_category_table_does_not_expand_the_lines(spark):
    text = plan(spark, "category_performance")
    assert "Expand" not in text


@pytest.mark.parametrize("name", ["sliding_rate", "sliding_kpis"])
def test_sliding_windows_repeat_slides_not_rows(spark, name):
    """Under the row expansion of the windows there is an aggregate of the slides."""
    text = plan(spark, name)
    assert "HashAggregate" in text[text.index("Expand") :]


def test_the_sample_of_lines_is_cut_before_the_join(spark):
    text = plan(spark, "order_line_sample")
    assert text.count("TakeOrderedAndProject") == 1 and text.index("Join") < text.index("TakeOrderedAndProject")


def test_the_status_filter_and_the_columns_reach_the_scan(spark):
    text = plan(spark, "payment_mix")
    assert "EqualTo(o_orderstatus,F)" in text
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert all("l_shipdate" not in columns and "l_tax" not in columns for columns in read)


@pytest.mark.parametrize("name", ["payment_mix", "rfm_features", "churn_risk", "nps_segments", "cohort_retention"])
def test_user_tables_do_not_touch_the_product_table(spark, name):
    assert "part.parquet" not in plan(spark, name)


@pytest.mark.parametrize("name", ["monthly_pl", "weekly_trend", "brand_performance", "payment_mix", "nps_segments", "city_sales"])
def test_the_order_table_is_scanned_once(spark, name):
    assert len(re.findall(r"FileScan parquet \[[^\]]*o_orderkey", plan(spark, name))) == 1


@pytest.mark.parametrize("name", ["abc_pareto", "minute_trend"])
def test_the_ranking_window_is_partitioned(spark, name):
    """The only gathering is the one row per range that the offsets need."""
    text = plan(spark, name)
    for line in text.splitlines():
        if re.search(r"Window \[.*row_number", line):
            assert "_range" in line.split("], [")[-2]
    assert text.count("Exchange SinglePartition") <= 1


def test_a_task_gets_a_bounded_part_of_a_shuffle(spark):
    """What a task sorts and aggregates follows from the bytes it reads; cores must not matter here."""
    first = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    spark.conf.set(first, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        rows = spark.range(3_000_000).selectExpr("id", "rand(1) AS x", "rand(2) AS y")
        parts = rows.repartition("id").groupBy("id").agg({"x": "max", "y": "max"}).rdd.getNumPartitions()
    finally:
        spark.conf.unset(first)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert parts >= 3
