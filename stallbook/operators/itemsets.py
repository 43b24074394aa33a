"""Frequent itemsets and rules from bitmaps: no basket is ever held whole.

Groups (users, orders) are numbered and cut into ranges. An item has one bitmap per range, one bit for each group. An
itemset's bitmap is the intersection of its items' bitmaps in the same range, and its support is the sum of the set bits
over the ranges. A group that owns the whole catalogue costs one bit per item, a popular item one bit per group.

Itemsets grow level by level: two sets that agree in all but their last item make a candidate. Only the bitmaps of single
items are written. A task gets those of some neighbouring ranges and a part of the candidates, intersects them with numpy
and returns one number per candidate; the numbers are added up over the ranges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import joined, ratio
from ..plans.ranking import running_totals
from ..plans.staging import stage

# Groups in a range: a bitmap of at most 128 words.
RANGE = 8192
_WORD = 64
# Ranges and candidates that are counted together: 8 KB for each frequent item and 3 MB of counts.
_RANGES, _CANDIDATES = 8, 1 << 17


def _bits(words: Column | str) -> Column:
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda total, word: total + F.bit_count(word))


def item_bitmaps(rows: DataFrame, by: str, item: str, size: int = RANGE) -> tuple[DataFrame, int]:
    """(item, range, words) of each item and range it occurs in, and the number of groups.

    Rows may repeat. A null group is a group; null items belong to no bitmap. Bitmaps have as many words as the
    largest range needs, at most `size` / 64.
    """
    numbered = running_totals(rows.select(F.col(by).alias("_by")).distinct(), [F.col("_by")], {}, rank="_number")
    numbered = stage(numbered.select("_by", (F.col("_number") - 1).alias("_number")), "groups")
    groups = numbered.count()
    length = -(-min(size, groups) // _WORD)
    place = F.col("_number") % size
    held = rows.where(F.col(item).isNotNull()).select(F.col(by).alias("_of"), F.col(item).cast("string").alias("item")).distinct()
    bits = held.join(numbered, F.col("_of").eqNullSafe(F.col("_by"))).select(
        "item",
        F.floor(F.col("_number") / size).alias("range"),
        F.floor(place / _WORD).cast("int").alias("at"),
        F.expr(f"shiftleft(1L, CAST(_number % {_WORD} AS INT))").alias("bit"),
    )
    words = bits.groupBy("item", "range", "at").agg(F.bit_or("bit").alias("word"))
    # a range has few words, so the lists are short whatever the item
    listed = words.groupBy("item", "range").agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("by_place"))
    full = F.transform(F.sequence(F.lit(0), F.lit(max(length, 1) - 1)), lambda at: F.coalesce(F.col("by_place")[at], F.lit(0).cast("bigint")))
    return listed.select("item", "range", full.alias("words")), groups


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists in a row, and where each list begins and the last ends."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))


def _counted(maps: pa.Table, sets: pa.Table) -> pa.Table:
    """(id, next, freq): in how many groups of these ranges a set and one of its next items occur; nothing where in none."""
    ids, nexts, freqs = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    if len(maps) and len(sets):
        own, row = np.unique(maps["at"].to_numpy(), return_inverse=True)
        words = _lists(maps["words"])[0].view(np.uint64).reshape(len(maps), -1)
        # an item that does not occur here has the row of zeros at the end
        bits = np.zeros((len(own) + 1, _RANGES, words.shape[1]), np.uint64)
        bits[row, maps["place"].to_numpy()] = words
        bits = bits.reshape(len(own) + 1, -1)
        given, _ = _lists(sets["ats"])
        other, ends = _lists(sets["nexts"])
        wanted = np.concatenate([given, other])
        found = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
        found = np.where(own[found] == wanted, found, len(own))
        first, second = found[: len(given)].reshape(len(sets), -1), found[len(given) :]
        for n, key in enumerate(sets["id"].to_numpy()):
            both = np.bitwise_and.reduce(bits[first[n]], axis=0)
            live = np.flatnonzero(both)
            if not len(live):
                continue
            part = slice(ends[n], ends[n + 1])
            counts = np.bitwise_count(bits[second[part, None], live] & both[live]).sum(axis=1, dtype=np.int64)
            some = counts > 0
            ids.append(np.full(int(some.sum()), key))
            nexts.append(other[part][some])
            freqs.append(counts[some])
    return pa.table({"id": np.concatenate(ids), "next": np.concatenate(nexts), "freq": np.concatenate(freqs)})


def _supports(maps: DataFrame, grown: DataFrame, candidates: int, partitions: int | None) -> DataFrame:
    """(id, next, freq) of each candidate that occurs; a task holds some ranges of all items and a part of the candidates."""
    parts, keys = -(-candidates // _CANDIDATES), ["block", "part"]
    blocks = maps.select(F.col("block").alias("block")).distinct()
    left = maps.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = grown.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).crossJoin(blocks)
    if partitions is not None:
        left, right = left.repartition(partitions, *keys), right.repartition(partitions, *keys)
    counted = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_counted, "id bigint, next bigint, freq bigint")
    return counted.groupBy("id", "next").agg(F.sum("freq").alias("freq"))


def frequent_itemsets(
    rows: DataFrame, by: str, item: str, min_support: float = 0.01, size: int = RANGE, partitions: int | None = None
) -> tuple[DataFrame, int]:
    """(items, freq) of every itemset in at least `min_support` of the groups, items in order, and the number of groups.

    Runs jobs: a few per level, and there are as many levels as the largest itemset has items. An empty table gives no
    itemsets. Candidates are counted in as many partitions as Spark chooses unless told otherwise.
    """
    maps, groups = item_bitmaps(rows, by, item, size)
    least = F.ceil(F.lit(min_support) * groups)
    maps = stage(maps, "bitmaps")
    single = maps.groupBy("item").agg(F.sum(_bits("words")).alias("freq")).where(F.col("freq") >= least)
    single = stage(running_totals(single, [F.col("item")], {}, rank="at"), "itemsets")
    maps = maps.join(single.select("item", "at"), "item").select(
        "at", F.floor(F.col("range") / _RANGES).alias("block"), (F.col("range") % _RANGES).cast("int").alias("place"), "words"
    )
    maps = stage(maps, "bitmaps")
    number = F.monotonically_increasing_id().alias("id")
    level = stage(single.select(number, F.array("at").alias("ats"), F.array("item").alias("items"), "freq"), "level")
    found = [level]
    while True:
        prefix, last = F.slice("ats", 1, F.size("ats") - 1).alias("prefix"), F.element_at("ats", -1)
        left = level.select("id", "ats", prefix, last.alias("last"))
        met = left.join(level.select(prefix, last.alias("next")), "prefix").where(F.col("last") < F.col("next"))
        grown = stage(met.groupBy("id", "ats").agg(F.sort_array(F.collect_list("next")).alias("nexts")), "candidates")
        candidates = grown.agg(F.sum(F.size("nexts"))).first()[0]
        if not candidates:
            break
        counts = _supports(maps, grown, candidates, partitions).where(F.col("freq") >= least)
        named = counts.join(single.select(F.col("at").alias("next"), "item"), "next").join(level.drop("freq"), "id")
        level = stage(
            named.select(number, F.concat("ats", F.array("next")).alias("ats"), F.concat("items", F.array("item")).alias("items"), "freq"), "level"
        )
        if level.isEmpty():
            break
        found.append(level)
    sets = found[0]
    for more in found[1:]:
        sets = sets.union(more)
    return sets.select("items", "freq"), groups


def rules_of(itemsets: DataFrame, groups: int, min_confidence: float = 0.1) -> DataFrame:
    """Rules with one consequent: antecedent and consequent as text, confidence, lift and support."""
    sets = stage(itemsets, "rule-sets")
    larger = sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("then"))
    larger = larger.select(F.array_remove("items", F.col("then")).alias("given"), "then", "freq")
    given = sets.select(F.col("items").alias("given"), F.col("freq").alias("given_freq"))
    then = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("then"), F.col("freq").alias("then_freq"))
    confidence = ratio("freq", "given_freq")
    return (
        larger.join(given, "given")
        .where(confidence >= min_confidence)
        .join(then, "then")
        .select(
            joined("given").alias("antecedent"),
            F.col("then").alias("consequent"),
            confidence.alias("confidence"),
            (confidence / ratio("then_freq", F.lit(groups))).alias("lift"),
            ratio("freq", F.lit(groups)).alias("support"),
        )
    )


def vertical_rules(
    rows: DataFrame,
    by: str = "user_id",
    item: str = "name",
    min_support: float = 0.01,
    min_confidence: float = 0.1,
    size: int = RANGE,
    partitions: int | None = None,
) -> DataFrame:
    """The rules of ``basket.association_rules`` straight from the rows, without one array per group."""
    itemsets, groups = frequent_itemsets(rows, by, item, min_support, size, partitions)
    return rules_of(itemsets, groups, min_confidence)
