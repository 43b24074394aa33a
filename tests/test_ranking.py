import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallbook.plans.ranking import moving_average, running_totals
from stallbook.plans.staging import stage, work_folder


@pytest.fixture(scope="module")
def scores(spark):
    # a third of all rows share one value, so ties must spread over ranges
    return spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)))
        .cast("decimal(18,2)")
        .alias("score"),
    )


@pytest.mark.parametrize("ranges", [1, 4, 16])
def test_running_totals_equal_a_plain_window(scores, ranges):
    order = [F.desc("score"), F.asc("id")]
    window = Window.orderBy(*order)
    expected = scores.select(
        "id",
        "score",
        F.row_number().over(window).cast("bigint").alias("rank"),
        F.sum("score").over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
        F.sum("score").over(Window.partitionBy()).alias("so_far_of"),
    )
    got = running_totals(scores, order, {"so_far": "score"}, ranges=ranges)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_ties_are_spread_over_ranges(scores):
    ranged = scores.repartitionByRange(8, F.desc("score"), F.asc("id"))
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * 3000 / 8


def test_running_totals_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "id bigint, score decimal(18,2)")
    assert running_totals(empty, [F.asc("id")], {"so_far": "score"}).collect() == []


def test_moving_average_equals_pandas(scores):
    few = scores.filter("id < 100")
    got = moving_average(few, [F.asc("id")], "score", 5, "mean", ranges=4).toPandas().sort_values("id")
    plain = few.toPandas().sort_values("id")["score"].astype(float).rolling(5).mean()
    pd.testing.assert_series_equal(got["mean"].reset_index(drop=True), plain.reset_index(drop=True), check_names=False)


def test_stage_writes_into_the_named_folder(spark):
    frame = spark.range(5).withColumn("twice", F.col("id") * 2)
    kept = stage(frame, "five")
    assert kept.dtypes == frame.dtypes
    assert sorted(map(tuple, kept.collect())) == [(i, 2 * i) for i in range(5)]
    assert all(work_folder(spark) in name for name in kept.inputFiles())
