"""Baskets and association rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.staging import stage
from .itemsets import vertical_rules


def baskets(sales: DataFrame, by: str = "user_id", item: str = "name") -> DataFrame:
    """Distinct items per user or order.

    Repeats are removed while the set is built on the map side, so a basket is
    bounded by the list of items, not by the number of lines. One basket is one
    array in one task: where a user may hold a large share of a large
    catalogue, group by order, or take brands or categories as items; items are
    never cut.
    """
    return sales.groupBy(by).agg(F.collect_set(item).alias("items"))


def association_rules(
    groups: DataFrame, min_support: float = 0.01, min_confidence: float = 0.1, partitions: int | None = None
) -> DataFrame:
    """Rules with confidence, lift and support; item lists as text.

    Runs jobs: baskets are numbered, staged and mined by bitmaps, so no task holds
    a tree of the baskets; candidates are counted in as many partitions as Spark
    chooses unless told otherwise. An empty basket counts as one, a null basket
    does not; repeated items count once, null items are none.
    """
    held = groups.where(F.col("items").isNotNull())
    held = stage(held.select(F.monotonically_increasing_id().alias("basket"), "items"), "baskets")
    rows = held.select("basket", F.explode_outer("items").alias("item"))
    return vertical_rules(rows, "basket", "item", min_support, min_confidence, partitions=partitions)
