"""Distinct counts from bitmaps."""

import random

from stallbook.operators import distinct

random.seed(4)
ROWS = [(random.choice("abc"), f"2024-{random.randint(1, 12):02d}", random.choice([None, -5, 0, 7, 32767, 32768, 10**12, *range(40)])) for _ in range(600)]


def made(spark):
    rows = spark.createDataFrame(ROWS, "shop string, month string, user_id long").repartition(5)
    return distinct.distinct_bitmaps(rows, ["shop", "month"], "user_id")


def plain(key):
    found = {}
    for row in ROWS:
        found.setdefault(key(row), set()).add(row[2])
    return {k: len(v - {None}) for k, v in found.items()}


def test_months_unite_to_years_and_shops(spark):
    maps = made(spark)
    by = {(r.shop, r.month): r.n for r in distinct.distinct_counts(maps, ["shop", "month"], "n").collect()}
    assert by == plain(lambda r: (r[0], r[1]))
    assert {r.shop: r.n for r in distinct.distinct_counts(maps, ["shop"], "n").collect()} == plain(lambda r: r[0])


def test_rolling_months(spark):
    found = {(r.shop, r.month): r.n for r in distinct.rolling_counts(made(spark), "month", ["shop"], 3, "n").collect()}
    for (shop, month), n in found.items():
        near = {r[2] for r in ROWS if r[0] == shop and 0 <= int(month[5:]) - int(r[1][5:]) < 3} - {None}
        assert n == len(near)
    assert set(found) == {(r[0], r[1]) for r in ROWS}


def test_null_values_and_empty_rows(spark):
    rows = spark.createDataFrame([("a", None), (None, 3)], "shop string, user_id long")
    counts = distinct.distinct_counts(distinct.distinct_bitmaps(rows, ["shop"], "user_id"), ["shop"], "n")
    assert {r.shop: r.n for r in counts.collect()} == {"a": 0, None: 1}
    assert distinct.distinct_counts(distinct.distinct_bitmaps(rows.limit(0), ["shop"], "user_id"), ["shop"], "n").count() == 0
