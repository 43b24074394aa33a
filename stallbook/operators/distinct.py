"""Exact distinct counts that add up, as bitmaps.

A value is one bit: ids fall into buckets of 32,768, and a bucket is a bitmap of 4 KB. Bitmaps of months, stores or other
pieces are united by OR, so a year's count needs the stored bitmaps of its months and no line. The values must be ids
of a range that is well filled, such as customer numbers: a piece costs at most one bit for each number up to the
largest id, and 4 KB for a bucket with a single id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"


def distinct_bitmaps(rows: DataFrame, keys: Sequence[Column | str], value: str) -> DataFrame:
    """The keys, bucket and bits: which values occur with the keys. Null values set no bit, but keep their keys."""
    number = F.col(value).cast("bigint")
    return rows.groupBy(*keys, F.bitmap_bucket_number(number).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)
    )


def united(bitmaps: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """The bitmaps of coarser keys."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """The keys and the number of distinct values of all bitmaps with them."""
    names = [k if isinstance(k, str) else f"_key{i}" for i, k in enumerate(keys)]
    named = [F.col(k) if isinstance(k, str) else k.alias(n) for k, n in zip(keys, names)]
    return united(bitmaps, named).groupBy(*names).agg(F.sum(F.bitmap_count(BITS)).cast("bigint").alias(name))


def rolling_counts(bitmaps: DataFrame, month: str, keys: Sequence[str], months: int, name: str) -> DataFrame:
    """Distinct values of each month and the months before it, `months` in all; months are yyyy-MM.

    Each month's bitmaps are handed to the windows they belong to: bitmaps are repeated, rows are not. Windows end at
    months that have a row of the same keys.
    """
    first = F.to_date(month, "yyyy-MM")
    later = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda i: F.date_format(F.add_months(first, i), "yyyy-MM"))
    ends = bitmaps.select(*keys, month).distinct()
    spread = bitmaps.withColumn(month, F.explode(later))
    agree = [spread[k].eqNullSafe(ends[k]) for k in [*keys, month]]
    return distinct_counts(spread.join(ends, agree, "left_semi"), [*keys, month], name)
