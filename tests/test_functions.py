from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stallbook import functions as fn
from stallbook.functions.bands import first_match


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("value", "label"), [(0, "low"), (50, "low"), (50.01, "mid"), (100, "mid"), (101, "high"), (None, "high")]
)
def test_band_closed_on_the_right(spark, value, label):
    steps = ((50, "low"), (100, "mid"))
    assert one(spark, fn.band(F.lit(value).cast("double"), steps, "high")) == label


def test_band_open_on_the_right(spark):
    assert one(spark, fn.band(F.lit(50), ((50, "low"),), "rest", inclusive=False)) == "rest"


@pytest.mark.parametrize(("value", "label"), [(100, "top"), (99, "good"), (50, "good"), (49, "rest")])
def test_tier_takes_the_first_floor_reached(spark, value, label):
    assert one(spark, fn.tier(F.lit(value), ((100, "top"), (50, "good")), "rest")) == label


def test_first_match_prefers_the_earlier_test(spark):
    tests = [(F.lit(False), "a"), (F.lit(True), "b"), (F.lit(True), "c")]
    assert one(spark, first_match(tests, "d")) == "b"


def test_ratio_is_null_on_zero(spark):
    assert one(spark, fn.ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.percent(F.lit(1), F.lit(8), 1)) == 12.5


@pytest.mark.parametrize(("value", "places", "rounded"), [(1.005, 2, 1.01), (-1.005, 2, -1.01), (2.5, 0, 3.0)])
def test_half_up(spark, value, places, rounded):
    assert one(spark, fn.half_up(F.lit(value), places)) == rounded


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals("-99999999.99", "99999999.99", places=2), min_size=1, max_size=20))
def test_sum_money_is_exact(spark, amounts):
    frame = spark.createDataFrame([(a,) for a in amounts], "a decimal(18,2)")
    assert frame.agg(fn.sum_money("a").alias("s")).first()["s"] == sum(amounts, Decimal(0))


def test_sum_money_of_nothing_is_null(spark):
    assert spark.createDataFrame([], "a decimal(18,2)").agg(fn.sum_money("a").alias("s")).first()["s"] is None


@pytest.mark.parametrize(
    ("value", "currency", "text"),
    [
        (1_234_567_890.0, True, "$1.2B"),
        (-2_500_000.0, True, "$-2.5M"),
        (1_250.0, False, "1.2K"),
        (999.5, False, "1,000"),
        (2.5, True, "$2"),
        (None, True, "N/A"),
        (float("nan"), True, "N/A"),
    ],
)
def test_compact_number(spark, value, currency, text):
    assert one(spark, fn.compact_number(F.lit(value).cast("double"), currency)) == text


@pytest.mark.parametrize("value", [0.0, 0.5, 1.5, 999.49, 1000.0, 1050.0, 1949.99, 1e6, 1.25e6, 999_949.0, 3.15e9])
def test_compact_number_agrees_with_python_formatting(spark, value):
    for limit, unit in ((1e9, "B"), (1e6, "M"), (1e3, "K")):
        if abs(value) >= limit:
            expected = f"{value / limit:.1f}{unit}"
            break
    else:
        expected = f"{value:,.0f}"
    assert one(spark, fn.compact_number(F.lit(value), currency=False)) == expected


@pytest.mark.parametrize(
    ("day", "month", "week", "monday", "name", "number"),
    [
        ("2024-12-30", "2024-12", "2025-W01", "2024-12-30", "Monday", 1),
        ("2023-01-01", "2023-01", "2022-W52", "2022-12-26", "Sunday", 7),
        ("2020-12-31", "2020-12", "2020-W53", "2020-12-28", "Thursday", 4),
    ],
)
def test_calendar_keys(spark, day, month, week, monday, name, number):
    when = F.lit(day).cast("timestamp")
    assert one(spark, fn.month_key(when)) == month
    assert one(spark, fn.iso_week(when)) == week
    assert str(one(spark, fn.week_start(when))) == monday
    assert one(spark, fn.weekday_name(when)) == name
    assert one(spark, fn.weekday_number(when)) == number


def test_sums_keep_the_scale_of_the_column(spark):
    thin = spark.range(1000).selectExpr("0.004D AS binary", "CAST(0.004 AS DECIMAL(9,3)) AS fine", "CAST(1.25 AS DECIMAL(9,2)) AS cents", "2 AS whole")
    found = thin.agg(*(fn.sum_amount(thin, c).cast("double").alias(c) for c in thin.columns)).first()
    assert tuple(found) == (4.0, 4.0, 1250.0, 2000.0)


def test_month_gap_and_time_of_day(spark):
    assert one(spark, fn.month_gap(F.lit("2025-02"), F.lit("2023-11"))) == 15
    assert one(spark, fn.time_of_day(F.lit("2024-01-01 07:08:09").cast("timestamp"))) == "07:08:09"


def test_joined_and_ordinal(spark):
    assert one(spark, fn.joined(F.array(F.lit("b"), F.lit("a")))) == "a, b"
    assert one(spark, fn.ordinal_of(F.lit("y"), ("x", "y"))) == 1
    assert one(spark, fn.ordinal_of(F.lit("z"), ("x", "y"))) is None
