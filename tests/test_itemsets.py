"""Itemsets from bitmaps against brute force and against FP-growth."""

import math
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth

from stallbook.operators import basket, itemsets


def plain(groups, support):
    """Supports of all frequent itemsets by counting every subset."""
    least = math.ceil(support * len(groups))
    counts = {}
    for items in groups.values():
        for k in range(1, len(items) + 1):
            for some in combinations(sorted(items), k):
                counts[some] = counts.get(some, 0) + 1
    return {s: n for s, n in counts.items() if n >= least}


def shopping(spark, groups, repeat=1):
    rows = [(g, i) for g, items in groups.items() for i in items] * repeat
    return spark.createDataFrame(rows, "user_id long, name string").repartition(4)


def found(frame):
    return {tuple(r["items"]): r["freq"] for r in frame.collect()}


GROUPS = {u: {n for k, n in enumerate("abcdefg") if (u * 7 + k * k) % (k + 2) < 2} for u in range(1, 150)}
GROUPS = {u: items for u, items in GROUPS.items() if items}


@pytest.mark.parametrize("size", [8192, 64, 1])
def test_itemsets_equal_brute_force_for_any_range(spark, size):
    sets, groups = itemsets.frequent_itemsets(shopping(spark, GROUPS, repeat=2), "user_id", "name", 0.1, size)
    assert groups == len(GROUPS) and found(sets) == plain(GROUPS, 0.1)


def test_rules_equal_those_of_fp_growth(spark):
    rows = shopping(spark, GROUPS)
    old = basket.association_rules(basket.baskets(rows), 0.1, 0.3)
    new = itemsets.vertical_rules(rows, min_support=0.1, min_confidence=0.3)

    def plain_rows(frame):
        return sorted((r[0], r[1], *(round(x, 12) for x in r[2:])) for r in frame.collect())

    assert new.columns == old.columns and plain_rows(new) == plain_rows(old) != []


def test_one_group_with_the_whole_catalogue_costs_a_bit_per_item(spark):
    groups = {1: {f"item{i}" for i in range(3000)}} | {u: {"item1", "item2"} for u in range(2, 40)}
    maps, count = itemsets.item_bitmaps(shopping(spark, groups), "user_id", "name")
    assert count == 39 and maps.count() == 3000
    assert {len(r["words"]) for r in maps.collect()} == {1}
    sets, _ = itemsets.frequent_itemsets(shopping(spark, groups), "user_id", "name", 0.5)
    assert found(sets) == {("item1",): 39, ("item2",): 39, ("item1", "item2"): 39}


def test_nulls_and_empty_table(spark):
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (1, "a"), (2, None)], "user_id long, name string")
    sets, groups = itemsets.frequent_itemsets(rows, "user_id", "name", 0.3)
    assert groups == 3 and found(sets) == {("a",): 2, ("b",): 1, ("a", "b"): 1}
    assert itemsets.vertical_rules(rows.limit(0)).count() == 0


def test_rules_of_baskets_grow_no_trees(spark, monkeypatch):
    baskets = spark.createDataFrame(
        [(sorted(items),) for items in GROUPS.values()] + [([],), ([],), (None,)], "items array<string>"
    ).repartition(5)
    model = FPGrowth(itemsCol="items", minSupport=0.1, minConfidence=0.3).fit(baskets)
    expected = {
        (", ".join(sorted(r["antecedent"])), r["consequent"][0]): (r["confidence"], r["lift"], r["support"])
        for r in model.associationRules.collect()
    }
    monkeypatch.setattr(FPGrowth, "fit", lambda *_: pytest.fail("a tree of the baskets in every task"))
    for partitions in (None, 3):
        rules = basket.association_rules(baskets, 0.1, 0.3, partitions).collect()
        assert {(r[0], r[1]): tuple(r[2:]) for r in rules} == {k: pytest.approx(v) for k, v in expected.items()} != {}


def test_candidates_in_parts_and_ranges_add_up(spark, monkeypatch):
    monkeypatch.setattr(itemsets, "_CANDIDATES", 3)
    sets, _ = itemsets.frequent_itemsets(shopping(spark, GROUPS), "user_id", "name", 0.05, 8)
    assert found(sets) == plain(GROUPS, 0.05)
