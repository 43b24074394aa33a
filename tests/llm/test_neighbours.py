import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import rows as collected

from stallbook.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, every, k):
    ids, values = [i for i, _ in vectors], np.array([v for _, v in vectors], dtype=np.float64)
    norm = np.sqrt((values * values).sum(axis=1))
    result = {}
    for n, i in enumerate(ids):
        if i % every == 0:
            score = (values * values[n]).sum(axis=1) / (norm * norm[n])
            order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-round(score[j], 12), ids[j]))[:k]
            result[i] = [(ids[j], round(score[j], 9)) for j in order]
    return result


@pytest.mark.parametrize("tile", [7, 2048])
def test_matches_all_pairs_with_ties(spark, monkeypatch, tile):
    monkeypatch.setattr(neighbours, "TILE", tile)
    monkeypatch.setattr(neighbours, "STRETCH", 3)
    rng = np.random.default_rng(tile)
    base = rng.normal(size=(20, 16)).astype(np.float32)
    vectors = [(i, base[rng.integers(20)].tolist() if i % 3 else rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in vectors], SCHEMA).repartition(3)
    found = {}
    for r in collected(neighbours.nearest(frame, F.col("vec_id") % 10 == 0)):
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], round(r["score"], 9))
    assert {q: [x[n] for n in sorted(x)] for q, x in found.items()} == brute(vectors, 10, 5)


def test_error_bounds_hold():
    rng = np.random.default_rng(5)
    raw = rng.normal(size=(200, 32)) * rng.lognormal(size=(200, 1)) ** 4
    tile = neighbours._Tile(np.arange(200).astype("<i8").tobytes(), raw.astype("<f8").tobytes(), 32)
    about = neighbours._product(tile.codes, tile.codes) * (tile.step[:, None] * tile.step[None, :])
    slack = tile.length[:, None] * tile.error[None, :] + tile.error[:, None] * tile.length[None, :] + tile.error[:, None] * tile.error
    unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    assert (np.abs(unit @ unit.T - about) <= slack + 1e-12).all()


def test_awkward_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
        (6, [None, 1.0], 1), (7, [], 1), (8, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (9, [0.0, 3e38], 1), (9, [0.0, 3e38], 1),
        (10, [1e-40, 0.0], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("size", "serial", "ids", "rank", "score"):
        frame = frame.withColumn(name, F.lit("x"))
    found = collected(neighbours.nearest(frame, F.col("vec_id") % 10 == 0), "query_id", "rank")
    assert [(r["query_id"], r["vec_id"]) for r in found] == [(0, 10), (0, 1), (0, 9), (0, 9), (10, 0), (10, 1), (10, 9), (10, 9)]
    assert found[0]["score"] == 1.0 and abs(found[1]["score"] - 0.5**0.5) < 1e-15


def test_empty_table(spark):
    assert collected(neighbours.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 10 == 0)) == []


@pytest.mark.parametrize("meetings", [1, 1000])
def test_stretches_and_meetings_of_any_number_give_the_same(spark, monkeypatch, meetings):
    """Bounds in bytes, several dimensions, and a third of the rows equal."""
    for name, value in (("TILE", 8), ("HELD", 8 * 16 * 8 * 2), ("MEETINGS", meetings)):
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(9)
    vectors = [(i, [1.0] * 16 if i % 3 == 0 else rng.normal(size=16).astype(np.float32).tolist()) for i in range(240)]
    others = [(1000 + i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in vectors + others], SCHEMA).repartition(4)
    found = {}
    for r in collected(neighbours.nearest(frame, F.col("vec_id") % 10 == 0)):
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], round(r["score"], 9))
    assert {q: [x[n] for n in sorted(x)] for q, x in found.items()} == brute(vectors, 10, 5) | brute(others, 10, 5)


def test_candidates_move_once_and_queries_once_for_each_stretch(spark, monkeypatch):
    """Rows before the meeting, at two sizes: tiles of candidates, and tiles of queries times stretches."""
    for name, value in (("TILE", 4), ("STRETCH", 2), ("MEETINGS", 1)):
        monkeypatch.setattr(neighbours, name, value)
    moved = []
    repartition = type(spark.range(1)).repartition

    def watched(frame, *keys):
        if "side" in frame.columns:
            moved.append({r["side"]: r["count"] for r in frame.groupBy("side").count().collect()})
        return repartition(frame, *keys)

    frames = [spark.range(n).selectExpr("id AS vec_id", "array(float(id + 1), float(1))  AS embedding", "0 AS label").coalesce(1) for n in (160, 320)]
    monkeypatch.setattr(type(frames[0]), "repartition", watched)
    for frame in frames:
        neighbours.nearest(frame, F.col("vec_id") % 20 == 0)
    assert [counts[0] for counts in moved] == [40, 80]
    for counts, stretches, queries in zip(moved, (20, 40), (8, 16), strict=True):
        assert counts[1] % stretches == 0 and counts[1] <= stretches * queries
