"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target in words. target / size is how often each of its documents is wanted; the whole part is
taken for sure and the rest is an inclusion probability. The cube method turns these probabilities into zeros and ones:
it moves them along vectors in the null space of the constraints (document count and word total of the source), so
both totals stay as they are, until a step lands on a face of the cube and a unit is decided.

The flight runs in blocks of bounded size, made by a hash of the document, so a source of any size is spread over all
tasks. Equal rows are numbered first and the number is part of the hash, so that one hot document is spread like a source. A block leaves at most two undecided documents; these meet again in blocks, level by level, until a source has
one block. Its last documents are landed: of all ways to round them one that leaves the word total nearest to its target.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallbook.plans.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
BLOCK_ROWS = 4096
# Documents of a source, of all sizes, that stay out of its flights and are decided by the landing.
LANDING = 14
# Rows that are numbered together; a power of two.
CHUNK_ROWS = 1 << 16
SEED = 88172645
_ALMOST = 1e-9
_WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    Sources in code-point order, null last, have the weights in turn. A target is weight times a common level, at most
    `most` times the source; the level is where all targets add up to share times all sizes. With sources ordered by
    the level at which they are full, the full ones are a prefix, so running sums give the level (share <= most).
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.col("place") % len(weights) + 1)
    placed = sizes.select("*", (F.row_number().over(order) - 1).alias("place")).select(
        "source", "source_size", "place", weight.alias("weight")
    )
    cap = F.col("source_size") * F.lit(float(most))
    full_at = Window.orderBy(cap / F.col("weight"), "place")
    before = full_at.rowsBetween(Window.unboundedPreceding, -1)
    after = full_at.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    levels = placed.select(
        "*",
        F.coalesce(F.sum(cap).over(before), F.lit(0.0)).alias("spent"),
        F.sum("weight").over(after).alias("open_weight"),
        (F.sum("source_size").over(every) * F.lit(float(share))).alias("wanted"),
    )
    level = (F.col("wanted") - F.col("spent")) / F.col("open_weight")
    # the first source that its level does not fill sets the level of all that follow
    open_level = F.min(F.when(level * F.col("weight") <= cap, F.struct("place_in_order", level.alias("level")))).over(every)
    ranked = levels.select("*", F.row_number().over(full_at).alias("place_in_order"))
    found = ranked.select("*", open_level["place_in_order"].alias("first_open"), open_level["level"].alias("level"))
    target = F.when(F.col("place_in_order") < F.coalesce("first_open", F.lit(2**31 - 1)), cap).otherwise(
        F.least(F.col("level") * F.col("weight"), cap)
    )
    return found.select("source", "source_size", target.alias("target"))


def _reach(x: float, slope: float) -> float:
    """How far x can move by steps of slope before it leaves [0, 1]."""
    if slope > 0:
        return (1 - x) / slope
    return x / -slope if slope < 0 else math.inf


def _flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the probabilities along the null space of (1, size) until at most two of them are fractions."""
    probability, sizes, draws = p.tolist(), size.tolist(), rng.random(len(p)).tolist()
    held: list[int] = []
    for unit, draw in enumerate(draws):
        if 0 < probability[unit] < 1:
            held.append(unit)
        if len(held) < 3:
            continue
        i, j, k = held
        # orthogonal to (1, 1, 1) and to the three sizes
        slopes = (sizes[k] - sizes[j], sizes[i] - sizes[k], sizes[j] - sizes[i])
        longest = max(map(abs, slopes))
        slopes = tuple(s / longest for s in slopes) if longest else (1.0, -1.0, 0.0)
        at = [probability[h] for h in held]
        up = min(map(_reach, at, slopes))
        down = min(_reach(x, -s) for x, s in zip(at, slopes))
        step = up if draw * (up + down) < down else -down
        for h, x, s in zip(held, at, slopes):
            x += step * s
            probability[h] = 0.0 if x < _ALMOST else 1.0 if x > 1 - _ALMOST else x
        held = [h for h in held if 0 < probability[h] < 1]
    return np.array(probability)


def _land(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Decide the last fractions: of all their zero-one patterns one whose words, then documents, are nearest to what is due."""
    free = np.flatnonzero((p > 0) & (p < 1))
    patterns = (np.arange(1 << len(free))[:, None] >> np.arange(len(free))) & 1
    off_words = np.abs(patterns @ size[free] - p[free] @ size[free])
    off_count = np.abs(patterns.sum(axis=1) - p[free].sum())
    best = np.flatnonzero(off_words <= off_words.min() + 1e-6)
    best = best[off_count[best] <= off_count[best].min() + 1e-6]
    p = p.copy()
    p[free] = patterns[best[int(rng.integers(len(best)))]]
    return p


def _level(units: DataFrame, label: str, last: bool) -> DataFrame:
    """One flight in every block (group, block) of the units (group, block, unit, size, twin, p, late)."""

    def fly(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "unit", "twin"], kind="stable")
        rng = np.random.default_rng([SEED, int(block["group"].iloc[0]) % 2**63, int(block["block"].iloc[0])])
        p, size, late = block["p"].to_numpy(float).copy(), block["size"].to_numpy(float), np.flatnonzero(block["late"])
        if last and len(late) > LANDING:
            late = late[np.unique(np.linspace(0, len(late) - 1, LANDING).astype(int))]
        flying = np.setdiff1d(np.arange(len(p)), late)
        p[flying] = _flight(p[flying], size[flying], rng)
        return block.assign(p=_land(p, size, rng) if last else p)

    return stage(units.groupBy("group", "block").applyInPandas(fly, units.schema), label)


def sampled(units: DataFrame) -> DataFrame:
    """(group, unit, size, twin, p) with p decided, from units (group, unit, size and twin long, p double).

    About LANDING units of a group, chosen by a hash, wait for the landing. Group, unit, size and twin are a unit's key.
    """
    done, level, last = None, 0, False
    counts = stage(units.groupBy("group").count(), "mix-groups")
    waits = F.pmod(F.xxhash64("unit", "size", "twin", F.lit(SEED)), F.col("count")) < LANDING
    units = units.join(counts, "group").select("group", "unit", "size", "twin", "p", waits.alias("late"))
    while not last:
        blocks = F.ceil(F.col("count") / BLOCK_ROWS).cast("int")
        largest = counts.agg(F.max(F.col("count")).alias("n")).first()["n"] or 0
        last = largest <= BLOCK_ROWS
        block = F.pmod(F.xxhash64(F.lit(level), "group", "unit", "size", "twin"), F.greatest(blocks, F.lit(1))).cast("long")
        placed = units.join(counts, "group").select("group", block.alias("block"), "unit", "size", "twin", "p", "late")
        flown = _level(placed, f"mix-level{level}", last)
        decided = flown.where("p = 0 or p = 1").drop("block", "late")
        done = decided if done is None else done.union(decided)
        units = flown.where("p > 0 and p < 1").drop("block")
        if not last:
            counts = stage(units.groupBy("group").count(), "mix-groups")
        level += 1
    return done


def numbered(rows: DataFrame, keys: tuple[str, ...] = ("group", "unit", "size")) -> DataFrame:
    """The rows with `twin`: equal keys are numbered from 0, whatever their number, without one task for a hot key.

    Rows are written with a number of their chunk (at most CHUNK_ROWS rows of a task), counted by key and chunk, and
    numbered in their chunk from what the chunks before hold.
    """
    chunk = F.shiftright(F.monotonically_increasing_id(), CHUNK_ROWS.bit_length() - 1)
    written = stage(rows.withColumn("chunk", chunk), "mix-open")
    counts = written.groupBy(*keys, "chunk").agg(F.count("*").alias("held"))
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "chunk", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    own = Window.partitionBy(*keys, "chunk").orderBy(F.lit(0))
    placed = written.withColumn("place", F.row_number().over(own)).join(starts, [*keys, "chunk"])
    return placed.withColumn("twin", F.col("start") + F.col("place") - 1).drop("chunk", "start", "place")


def mixed(
    documents: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    share: float = SHARE,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = MOST_COPIES,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies times size) of each row.

    A null text has size 0 and is never taken, nor is any other text without words. Null sources are one source, last
    in order. Repeated rows are separate units, each taken up to `most` times. Keys may be null. An empty table gives
    an empty result. Runs on equal rows agree: blocks and random numbers follow hashes of the rows.
    """
    rows = stage(
        documents.select(
            F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), words_in(text).alias("size")
        ),
        "mix-sizes",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = stage(targets(sizes, share, weights, most), "mix-targets")
    known = aims.select(F.col("source").alias("__source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = rows.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    wanted = wanted.withColumns({"whole": F.floor(rate + _ALMOST), "p": F.greatest(rate - F.floor(rate + _ALMOST), F.lit(0.0))})
    wanted = wanted.withColumns(
        {
            "group": F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull()),
            "unit": F.coalesce("doc_id", F.lit(-1).cast("long")),
        }
    )
    # equal rows are told apart by a number, so that decisions can be handed back
    open_rows = stage(numbered(wanted.where("size > 0 and p > 0")), "mix-numbered")
    settled = wanted.where("size = 0 or p = 0")
    drawn = sampled(open_rows.select("group", "unit", "size", "twin", "p")).withColumnRenamed("p", "extra")
    out = open_rows.join(drawn, ["group", "unit", "size", "twin"]).withColumn("copies", F.col("whole") + F.col("extra").cast("long"))
    out = out.drop("twin", "extra").unionByName(settled.withColumn("copies", F.when(F.col("size") > 0, F.col("whole")).otherwise(0)))
    copies = F.col("copies").cast("long")
    return out.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
