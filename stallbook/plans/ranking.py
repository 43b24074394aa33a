"""Row numbers, running totals and moving averages over one global order.

A window without PARTITION BY moves every row to one task. Here the rows are
range-partitioned on the order instead, the range number is written with the
rows, and each range adds the totals of the ranges before it. Only one row per
range is ever gathered or broadcast, so that size is fixed by the number of
ranges, not by the data.

The order must end in a unique column: ties then spread over ranges and the
result does not depend on the run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .staging import stage

_RANGE = "_range"


def _widened(kind: T.DataType) -> T.DataType:
    """The type of a sum over this type, so that both summation levels agree."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(kind.precision + 10, 38), kind.scale)
    if isinstance(kind, T.IntegralType):
        return T.LongType()
    return T.DoubleType()


def running_totals(
    frame: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, str],
    rank: str = "rank",
    ranges: int | None = None,
) -> DataFrame:
    """Add a 1-based rank and inclusive running totals; ``totals`` maps new column to summed column.

    Each running total comes with its grand total as <column>_of.
    """
    if ranges is None:
        ranges = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(
        frame.repartitionByRange(ranges, *order).withColumn(_RANGE, F.spark_partition_id()), "ranges"
    )
    kinds = {out: _widened(frame.schema[source].dataType) for out, source in totals.items()}

    sizes = ranged.groupBy(_RANGE).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.sum(source).cast(kinds[out]).alias(f"_sum_{out}") for out, source in totals.items()),
    )
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    offsets = sizes.select(
        _RANGE,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        *(
            F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).cast(kinds[out]).alias(f"_before_{out}")
            for out in totals
        ),
        *(F.sum(f"_sum_{out}").over(whole).cast(kinds[out]).alias(f"{out}_of") for out in totals),
    )

    inside = Window.partitionBy(_RANGE).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(F.broadcast(offsets), _RANGE).select(
        *frame.columns,
        (F.col("_rows_before") + F.row_number().over(inside)).cast("bigint").alias(rank),
        *(
            (F.col(f"_before_{out}") + F.sum(source).over(so_far)).cast(kinds[out]).alias(out)
            for out, source in totals.items()
        ),
        *(f"{out}_of" for out in totals),
    )


def moving_average(
    frame: DataFrame,
    order: Sequence[Column],
    value: str,
    window: int,
    name: str,
    ranges: int | None = None,
) -> DataFrame:
    """Mean of the current and the previous window-1 rows; NULL until that many rows exist.

    Ranges are kept as they are. Each gets the last window-1 rows before it
    (ranges times window rows in all), so the frame ends inside the range.
    """
    if ranges is None:
        ranges = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(
        frame.repartitionByRange(ranges, *order).withColumn(_RANGE, F.spark_partition_id()), "ranges"
    )
    size = ranged.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range: where it starts, and where the ranges after it start
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(_RANGE).rowsBetween(1, Window.unboundedFollowing)
    starts = size.select("*", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    starts = starts.select("*", F.collect_list(F.struct(_RANGE, "_start")).over(after).alias("_later"))
    # the last rows of a range go to those ranges whose first rows reach back to them
    inside = Window.partitionBy(_RANGE).orderBy(*order)
    placed = ranged.withColumn("_place", F.row_number().over(inside)).join(F.broadcast(starts), _RANGE)
    tail = placed.filter(F.col("_place") > F.col("_rows") - (window - 1))
    reach = F.col("_start") + F.col("_place") + window - 1
    lent = tail.select(
        *frame.columns, F.explode(F.filter("_later", lambda x: x["_start"] < reach)).alias("_to"), F.lit(False).alias("_own")
    ).select(*frame.columns, F.col(f"_to.{_RANGE}").alias(_RANGE), "_own")
    rows = ranged.select(*frame.columns, _RANGE, F.lit(True).alias("_own")).unionByName(lent)
    last = Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(-(window - 1), 0)
    mean = F.try_divide(F.sum(value).over(last).cast("double"), F.lit(float(window)))
    averaged = rows.select("*", F.when(F.count(value).over(last) == window, mean).alias(name))
    return averaged.filter("_own").select(*frame.columns, name)
