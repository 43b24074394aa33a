"""Exact nearest neighbours by cosine as a join of matrix blocks.

Vectors are scaled to length one and quantised to int8. The product of two int8 tiles gives every cosine up to an
error that follows from the quantisation errors of the two vectors; only pairs that may still be among the best are
computed again from the original vectors, in double precision, and merged into the heaps of their queries.

Tiles hold a bounded number of rows, and stretches a bounded number of candidate tiles. A task holds one stretch while
the query tiles stream by; a query keeps k pairs per stretch. So the candidates move once, however many queries there
are, and the queries once for each stretch. Only a table of fewer stretches than MEETINGS moves its candidates more
often, dealing the query tiles to that many meetings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.plans.staging import stage

# Rows in a tile, and candidate tiles in a stretch, fewer of them where their vectors exceed the bytes of HELD.
TILE, STRETCH, HELD = 2048, 16, 64 << 20
MEETINGS = 64
_PIECE = 256
_TILES = "size int, serial long, ids binary, raw binary, count int"


def _usable(ids: np.ndarray, lists: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and vectors of the rows that take part, as float64 scaled by a power of two against overflow."""
    kept, vectors = [], []
    for i, values in zip(ids, lists, strict=True):
        if i is None or values is None or not len(values) or any(v is None for v in values):
            continue
        vector = np.array(values, dtype=np.float64)
        largest = np.abs(vector).max()
        if np.isfinite(largest) and largest > 0:
            kept.append(i)
            vectors.append(np.ldexp(vector, -int(np.frexp(largest)[1])))
    return np.array(kept, np.int64), vectors


def _tiles(vectors: DataFrame, key: str, vector: str, rows: int) -> DataFrame:
    """Rows packed into tiles of equal dimension; cosine does not change by the scaling of a vector."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 32
        waiting: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def tile(size: int) -> pa.RecordBatch:
            nonlocal serial
            ids, values = waiting.pop(size)
            serial += 1
            raw = np.stack(values).astype("<f8").tobytes()
            packed = [[size], [serial], [np.array(ids, "<i8").tobytes()], [raw], [len(ids)]]
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32()]
            return pa.RecordBatch.from_arrays(
                [pa.array(p, k) for p, k in zip(packed, kinds, strict=True)], ["size", "serial", "ids", "raw", "count"]
            )

        for batch in batches:
            ids, found = _usable(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for i, values in zip(ids.tolist(), found, strict=True):
                own = waiting.setdefault(len(values), ([], []))
                own[0].append(i)
                own[1].append(values)
                if len(own[0]) >= rows:
                    yield tile(len(values))
        for size in list(waiting):
            yield tile(size)

    source = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    return source.mapInArrow(pack, _TILES)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of columns, added up dimension by dimension: unlike a matrix product, equal vectors get equal numbers."""
    total = np.zeros(a.shape[1])
    for x, y in zip(a, b, strict=True):
        total += x * y
    return total


class _Tile:
    """A tile with what its int8 form lacks: codes * step + error = unit vector."""

    def __init__(self, ids: bytes, raw: bytes, size: int):
        self.ids = np.frombuffer(ids, "<i8")
        vectors = np.frombuffer(raw, "<f8").reshape(-1, size)
        self.columns = np.ascontiguousarray(vectors.T)
        self.norm = np.sqrt(_dots(self.columns, self.columns))
        unit = vectors / self.norm[:, None]
        self.step = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / self.step[:, None])
        self.error = np.sqrt(((unit - codes * self.step[:, None]) ** 2).sum(axis=1))
        self.length = np.sqrt((codes * codes).sum(axis=1)) * self.step
        self.codes = codes.astype(np.int8)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of int8 tiles; float32 holds it exactly up to 1024 dimensions, float64 beyond."""
    kind = np.float32 if a.shape[1] <= 1024 else np.float64
    return a.astype(kind) @ b.astype(kind).T


class _Heaps:
    """The best k pairs of each query of a tile."""

    def __init__(self, queries: _Tile, k: int):
        self.queries, self.k = queries, k
        n = len(queries.ids)
        self.score = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def meet(self, other: _Tile) -> None:
        q = self.queries
        for low in range(0, len(q.ids), _PIECE):
            rows = slice(low, low + _PIECE)
            about = _product(q.codes[rows], other.codes) * (q.step[rows, None] * other.step[None, :])
            slack = q.length[rows, None] * other.error[None, :] + q.error[rows, None] * other.length[None, :]
            slack += q.error[rows, None] * other.error[None, :] + 1e-9
            sure = about - slack
            sure[q.ids[rows, None] == other.ids[None, :]] = -np.inf
            if sure.shape[1] > self.k:
                least = -np.partition(-sure, self.k - 1, axis=1)[:, self.k - 1]
            else:
                least = np.full(len(sure), -np.inf)
            floor = np.maximum(least, self.score[rows, -1] - 1e-9)
            may = (about + slack >= floor[:, None]) & (q.ids[rows, None] != other.ids[None, :])
            x, y = np.nonzero(may)
            for part in range(0, len(x), 1 << 18):
                self._merge(low + x[part : part + (1 << 18)], y[part : part + (1 << 18)], other)

    def _merge(self, x: np.ndarray, y: np.ndarray, other: _Tile) -> None:
        q = self.queries
        score = _dots(q.columns[:, x], other.columns[:, y]) / (q.norm[x] * other.norm[y])
        touched = np.unique(x)
        score = np.concatenate([score, self.score[touched].ravel()])
        ids = np.concatenate([other.ids[y], self.ids[touched].ravel()])
        x = np.concatenate([x, np.repeat(touched, self.k)])
        order = np.lexsort((ids, -score, x))
        x, score, ids = x[order], score[order], ids[order]
        begins = np.searchsorted(x, touched)
        rank = np.arange(len(x)) - np.repeat(begins, np.diff([*begins, len(x)]))
        best = rank < self.k
        self.score[x[best], rank[best]], self.ids[x[best], rank[best]] = score[best], ids[best]

    def rows(self) -> pa.RecordBatch:
        full = np.isfinite(self.score)
        query = np.repeat(self.queries.ids, self.k).reshape(self.score.shape)
        return pa.RecordBatch.from_arrays(
            [pa.array(query[full]), pa.array(self.ids[full]), pa.array(self.score[full])], ["query_id", "vec_id", "score"]
        )


def nearest(vectors: DataFrame, queries: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each row that `queries` selects, among all rows but itself.

    Nearest first by cosine, ties to the smaller key. Vectors that are null, empty, zero, or hold a null or non-finite
    component take no part, nor do rows without key; vectors of another dimension are never near. Rows with the query's
    key are the query itself. Other repeated rows are candidates each; a repeated query is answered once,
    for the smallest of its vectors. An empty table gives an empty result.
    """
    candidates = stage(_tiles(vectors, key, vector, TILE), "tiles")
    once = vectors.where(queries).groupBy(F.col(key).alias(key)).agg(F.min(vector).alias(vector))
    asked = stage(_tiles(once, key, vector, TILE), "query-tiles")
    # tiles of few rows are spread evenly by their serial numbers
    held = F.least(F.lit(STRETCH), F.greatest(F.lit(1), F.floor(F.lit(HELD) / (F.col("size") * (8 * TILE)))))
    stretches = F.greatest(F.ceil(F.col("tiles") / held), F.lit(1)).cast("int")
    asking = asked.groupBy("size").agg(F.count("*").alias("asking"))
    sizes = candidates.groupBy("size").agg(F.count("*").alias("tiles")).join(asking, "size")
    sizes = sizes.select("size", stretches.alias("stretches"), "asking").select(
        "*", F.least(F.col("asking"), F.ceil(F.lit(MEETINGS) / F.col("stretches"))).cast("int").alias("deals")
    )

    def dealt(column: str) -> Column:
        return F.pmod(F.xxhash64("serial"), F.col(column)).cast("int")

    def everywhere(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(column) - 1))

    place = ["size", "stretch", "deal"]
    fixed = (
        candidates.join(sizes, "size").withColumn("stretch", dealt("stretches")).withColumn("deal", everywhere("deals"))
        .select(*place, F.lit(0).alias("side"), "serial", "ids", "raw")
    )
    moving = (
        asked.join(sizes, "size").withColumn("deal", dealt("deals")).withColumn("stretch", everywhere("stretches"))
        .select(*place, F.lit(1).alias("side"), "serial", "ids", "raw")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stretch = None, []
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                if (row["size"], row["stretch"], row["deal"]) != here:
                    here, stretch = (row["size"], row["stretch"], row["deal"]), []
                tile = _Tile(row["ids"], row["raw"], row["size"])
                if row["side"] == 0:
                    stretch.append(tile)
                    continue
                heaps = _Heaps(tile, k)
                for candidate in stretch:
                    heaps.meet(candidate)
                yield heaps.rows()

    met = (
        fixed.union(moving).repartition(*place).sortWithinPartitions(*place, "side", "serial")
        .mapInArrow(meet, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
