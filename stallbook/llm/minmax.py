"""Near-duplicate documents by min-max hashing.

Each random permutation of the shingle hashes gives two signature values, the smallest and the largest, so half as many
permutations fill a signature. Values are banded; a band that two sets share makes them candidates.

Every link is confirmed on the full sets. Equal sets are one class from the start, and only classes are compared. In a
bucket all classes are compared with one of them first (linear in the bucket), and the links found make components.
What is then left in a bucket are pairs from different components. Those are compared too, in blocks of sets, each two
blocks in a task of their own. So no pair of a bucket goes unexamined and no bucket is capped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.words import LOWER, NOT_BLANK, U64, blocks, find_words, mix, shingles
from stallbook.plans.staging import stage

# 32 bands of 5 values: a pair at similarity 0.8 shares no band with probability 3e-6, one at 0.1 shares one with 3e-4.
BANDS, ROWS = 32, 5
SEED = 1307
# Classes in a block, and shingles looked at together, when blocks of sets meet.
_BLOCK, _COLUMNS = 256, 4096


def _permutations(count: int) -> np.ndarray:
    drawn = np.random.default_rng(SEED).integers(0, 2**63, count, dtype=np.int64)
    return drawn.astype(U64) * U64(2) + U64(1)


def _signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band hashes, one row per set; sets must not be empty."""
    sizes = np.array([len(s) for s in sets])
    every, begins = np.concatenate(sets), np.cumsum(sizes) - sizes
    values = np.empty((bands * rows + 1, len(sets)), dtype=U64)
    for i, factor in enumerate(_permutations((bands * rows + 1) // 2)):
        placed = every * factor
        values[2 * i] = np.minimum.reduceat(placed, begins)
        values[2 * i + 1] = np.maximum.reduceat(placed, begins)
    keys = np.empty((bands, len(sets)), dtype=U64)
    for band in range(bands):
        key = np.full(len(sets), band + 1, dtype=U64)
        for j in range(rows):
            key = mix(key * U64(5) + values[band * rows + j])
        keys[band] = key
    return keys.T.astype(np.int64)


def _name(members: np.ndarray) -> bytes | None:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest() if len(members) else None


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def signed(documents: DataFrame, width: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, set_key, bands) of each row; set_key and bands are null for an empty set."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                sets = shingles(find_words(block, NOT_BLANK, LOWER), width)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands = np.zeros((0, BANDS), np.int64)
                if full:
                    bands = _signatures([sets[i] for i in full], BANDS, ROWS)
                sizes = np.array([BANDS if len(s) else 0 for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.rows),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_name(s) for s in sets], pa.binary()),
                        _lists(bands.ravel(), sizes),
                    ],
                    ["doc_id", "n_shingles", "set_key", "bands"],
                )

    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(rows_of, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """(id, members), id the set_key and the sorted shingle hashes, of those rows (doc_id, set_key, text) whose set has that key."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expected = batch.column(1)
            for block in blocks(batch.column(2)):
                sets = shingles(find_words(block, NOT_BLANK, LOWER), width)
                keep = [i for i, s in enumerate(sets) if _name(s) == expected[block.first + i].as_py()]
                values = np.concatenate([*(sets[i] for i in keep), np.zeros(0, U64)]).astype(np.int64)
                ids = expected.take(pa.array([block.first + i for i in keep], pa.int64()))
                members = _lists(values, np.array([len(sets[i]) for i in keep], np.int64))
                yield pa.RecordBatch.from_arrays([ids, members], ["id", "members"])

    return texts.select("doc_id", "set_key", "text").mapInArrow(rows_of, "id binary, members array<long>")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the links (a, b); nodes has a column id.

    Each round takes the smallest label among a node and its neighbours and then that node's own label, so the
    number of rounds grows with the logarithm of the longest path. Every round is written; no round is on the driver.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stage(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("other")), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("other").alias("other"))
        )
        lower = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "other").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("component").alias("next"))
        moved = stage(
            lower.join(jump, "to").select("id", F.least("to", "next").alias("component"), "old"), "labels"
        )
        changed = moved.where(F.col("component") != F.col("old")).limit(1).count()
        labels = moved.select("id", "component")
        if not changed:
            break
    return nodes.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, both) of the pairs (a, b): shared shingles of the full sets, and the sum of their sizes."""
    pairs = stage(pairs.distinct(), "pairs")
    met = pairs.join(sets.select(F.col("id").alias("b"), F.col("members").alias("of_b")), "b")
    met = met.join(sets.select(F.col("id").alias("a"), F.col("members").alias("of_a")), "a")
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    both = (F.size("of_a") + F.size("of_b")).cast("long")
    return stage(met.select("a", "b", common.alias("common"), both.alias("both")), "tested")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each set on the left shares with each on the right."""
    every, count = np.unique(np.concatenate(left + right), return_counts=True)
    every = every[count > 1]
    result = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, len(every), _COLUMNS):
        part = every[low : low + _COLUMNS]
        marks = []
        for side in (left, right):
            mark = np.zeros((len(side), len(part)), dtype=np.float32)
            for row, members in enumerate(side):
                inside = members[np.searchsorted(members, part[0]) : np.searchsorted(members, part[-1], side="right")]
                at = np.searchsorted(part, inside)
                mark[row, at[part[at] == inside]] = 1
            marks.append(mark)
        result += marks[0] @ marks[1].T
    return result


def _between(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the components of what is compared with one head; a and b are components.

    rest: (head, id, component). Of two classes in different components one is outside the head's largest component. So
    the classes outside it are dealt into blocks, and so are all classes, and every outer block meets every block of all
    in a task of its own. That holds two blocks of sets and returns one link for two components at most, not their pairs.
    """
    rest = stage(rest.distinct(), "rest")
    sizes = rest.groupBy("head", "component").agg(F.count("*").alias("own"))
    largest = sizes.groupBy("head").agg(
        F.max(F.struct("own", "component")).alias("most"), F.sum("own").alias("every"), F.count("*").alias("components")
    )
    outside = F.col("every") - F.col("most.own")
    open_heads = largest.where("components > 1").select(
        "head",
        F.col("most.component").alias("main"),
        F.ceil(F.col("every") / _BLOCK).cast("int").alias("blocks"),
        F.ceil(outside / _BLOCK).cast("int").alias("outer"),
    )
    dealt = rest.join(open_heads, "head").withColumn("hash", F.xxhash64("id"))
    block, outer = F.pmod("hash", F.col("blocks")).cast("int"), F.pmod("hash", F.col("outer")).cast("int")
    every = dealt.select("head", "id", "component", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)).alias("i"), block.alias("j"), F.lit(False).alias("out"))
    others = dealt.where("component <> main").select(
        "head", "id", "component", outer.alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(True).alias("out")
    )
    dealt = stage(every.unionByName(others), "open")

    def meet(table: pa.Table) -> pa.Table:
        out = table["out"].to_numpy()
        names, component = np.unique(np.array(table["component"].to_pylist(), dtype=object), return_inverse=True)
        own = [np.sort(m.values.to_numpy()) for m in table["members"]]
        first, second = np.flatnonzero(out), np.flatnonzero(~out)
        pairs = set()
        if len(first) and len(second):
            common = _common([own[k] for k in first], [own[k] for k in second]).astype(np.int64)
            sizes = np.array([len(m) for m in own])
            union = sizes[first][:, None] + sizes[second][None, :] - common
            linked = (100 * common >= percent * union) & (component[first][:, None] != component[second][None, :])
            for x, y in zip(*np.nonzero(linked), strict=True):
                pairs.add(tuple(sorted((int(component[first[x]]), int(component[second[y]])))))
        ends = [pa.array([names[p[side]] for p in pairs], pa.binary()) for side in (0, 1)]
        return pa.table({"a": ends[0], "b": ends[1]})

    return dealt.join(sets, "id").groupBy("head", "i", "j").applyInArrow(meet, "a binary, b binary")


def near_duplicates(
    documents: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row.

    Words are runs without white space, A-Z lower-cased; the set of a text holds its distinct runs of `width` words,
    or the whole word sequence if it has fewer. Two texts are linked if common * 100 >= percent * union.

    A null or blank text has an empty set, is linked with nothing and is kept. A row without key takes no part:
    component_id is null and it is kept. Repeated rows are one document, and all of them are returned. Texts with
    different sets that share a key are compared each for itself, and a row has the component of its own text. An empty
    table gives an empty result. Columns besides key and text are not read.
    """
    signs = stage(signed(documents, width, text, key), "signatures")
    named = signs.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    # a class is known by its set; its bands are those of any of its rows
    classes = stage(named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands")), "classes")
    class_of = classes.select("set_key", "id")
    buckets = classes.select(F.col("set_key").alias("id"), F.explode("bands").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    met = stage(buckets.join(sizes, "bucket"), "buckets")

    wanted = met.select(F.col("id").alias("set_key")).distinct().join(class_of.withColumnRenamed("id", "doc_id"), "set_key")
    texts = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # the wanted ids grow with the corpus: they are matched by a shuffle at every size
    sets = full_sets(texts.join(wanted.hint("merge"), "doc_id").distinct(), width)
    sets = stage(sets.dropDuplicates(["id"]), "sets")

    # the head of a bucket is the member with the most company, which is the likeliest to be near the others
    company = met.groupBy("id").agg(F.sum("members").alias("company"))
    ranked = met.join(company, "id").groupBy("bucket").agg(F.max(F.struct("company", "id")).alias("head"))
    star = stage(met.join(ranked, "bucket").select("bucket", "id", F.col("head.id").alias("head")), "star").where("id <> head")
    asked = star.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b"))
    tested = _confirmed(asked, sets)
    joined = stage(components(met.select("id").distinct(), _links(tested, percent)), "components")

    # what the comparison with the heads leaves open
    rest = star.join(joined, "id").select("head", "id", "component")
    second = components(joined.select(F.col("component").alias("id")).distinct(), _between(rest, sets, percent))
    final = joined.join(second.select(F.col("id").alias("component"), F.col("component").alias("lowest")), "component").select(
        F.col("id").alias("set_key"), "lowest"
    )
    linked = stage(class_of.join(final, "set_key"), "linked-classes")
    lowest = linked.groupBy("lowest").agg(F.min("id").alias("found"))
    labelled = class_of.join(linked.join(lowest, "lowest").select("set_key", "found"), "set_key", "left")
    labelled = labelled.select("set_key", F.coalesce("found", "id").alias("found"))
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("found", "doc_id"))
    return (
        signs.select("doc_id", "n_shingles", "set_key")
        .join(labelled, "set_key", "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _links(tested: DataFrame, percent: int) -> DataFrame:
    return tested.where(F.col("common") * 100 >= percent * (F.col("both") - F.col("common"))).select("a", "b")
