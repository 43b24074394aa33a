import random

import numpy as np
import pytest
from tests.conftest import rows as collected

from stallbook.llm import mixing

from .conftest import awkward


def plain_targets(sizes, share=1.5, weights=(5, 2, 1), most=2):
    """Share by weight; what exceeds a source's limit is shared again among the rest."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ones = [s for s in names if s not in full]
        if not open_ones:
            return target
        level = left / sum(weight[s] for s in open_ones)
        over = [s for s in open_ones if level * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_ones}
        for s in over:
            full.add(s)
            target[s] = most * sizes[s]
            left -= target[s]


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {name: rng.choice([0, 3, 50, 700, 12000]) for name in ["a", "B", "é", "🎉", "￿", "b", "c", None][: rng.randint(1, 8)]}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in collected(mixing.targets(frame))}
    assert found == pytest.approx(plain_targets(sizes))


def test_flight_keeps_totals_and_leaves_two_fractions():
    rng = np.random.default_rng(2)
    p, size = rng.random(500), rng.integers(1, 5000, 500).astype(float)
    q = mixing._flight(p, size, rng)
    assert q.sum() == pytest.approx(p.sum()) and q @ size == pytest.approx(p @ size)
    assert ((q > 0) & (q < 1)).sum() <= 2 and ((q >= 0) & (q <= 1)).all()


def test_flight_keeps_probabilities_on_average():
    p, size = np.array([0.2, 0.5, 0.7, 0.4, 0.9, 0.3]), np.array([3.0, 8.0, 1.0, 4.0, 4.0, 9.0])
    mean = np.mean([mixing._flight(p, size, np.random.default_rng(i)) for i in range(3000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


def mix_rows(n=900):
    rng = random.Random(1)
    return [(i, "w " * rng.choice([1, 20, 100, 700]), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]


def test_sources_come_near_their_targets_over_several_levels(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 40)
    rows = mix_rows()
    found = collected(mixing.mixed(documents(rows)))
    assert len(found) == len(rows)
    for source in ("a", "b", "c", None):
        own = [r for r in found if r["source"] == source]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(20, own[0]["target"] * 0.002)
        assert all(0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in own)


def test_reruns_agree_whatever_the_partitions(documents):
    rows = mix_rows(300)
    first = collected(mixing.mixed(documents(rows, 2)), "doc_id")
    assert first == collected(mixing.mixed(documents(rows[::-1], 5)), "doc_id")


def test_awkward_rows(documents):
    found = collected(mixing.mixed(documents(awkward())))
    assert len(found) == 10
    assert {r["doc_id"]: r["taken"] for r in found if r["doc_id"] in (1, 2, 3)} == {1: 0, 2: 0, 3: 0}
    assert all(r["size"] > 0 for r in found if r["taken"])


def test_empty_table(documents):
    assert collected(mixing.mixed(documents([]))) == []
    assert {r["taken"] for r in collected(mixing.mixed(documents([(1, None), (2, "")])))} == {0}


def test_a_hot_document_is_spread_over_blocks(spark, documents, monkeypatch):
    """A third of the rows are one; no block exceeds its bound by more than hashing does, and the totals hold."""
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 100)
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 64)
    largest = []
    level = mixing._level

    def watched(units, label, last):
        largest.append(units.groupBy("group", "block").count().agg({"count": "max"}).first()[0])
        return level(units, label, last)

    monkeypatch.setattr(mixing, "_level", watched)
    rng = random.Random(5)
    rows = [(7, "w " * 30, "en", "a")] * 1000 + [(100 + i, "w " * rng.choice([3, 40, 200]), "en", "ab"[i % 2]) for i in range(2000)]
    rng.shuffle(rows)
    found = collected(mixing.mixed(documents(rows)))
    assert len(found) == len(rows) and sum(r["doc_id"] == 7 for r in found) == 1000
    assert max(largest) <= 150
    for source in "ab":
        own = [r for r in found if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(20, own[0]["target"] * 0.002)
    kinds = lambda rows: sorted((r["doc_id"], r["taken"]) for r in rows)
    assert kinds(found) == kinds(collected(mixing.mixed(documents(rows[::-1], 7))))


def test_equal_rows_are_numbered_without_gaps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 8)
    keys = [(1, 1, 1)] * 100 + [(1, 2, 1)] * 3 + [(2, 1, 1)] * 40
    random.Random(3).shuffle(keys)
    frame = spark.createDataFrame(keys, "group long, unit long, size long").repartition(5)
    twins = {}
    for r in mixing.numbered(frame).collect():
        twins.setdefault((r["group"], r["unit"], r["size"]), []).append(r["twin"])
    assert {k: sorted(v) for k, v in twins.items()} == {(1, 1, 1): [*range(100)], (1, 2, 1): [0, 1, 2], (2, 1, 1): [*range(40)]}
