"""The trie of all conversation prefixes, in double arrays.

Equal conversations are one path. The distinct paths are put in order and cut into shards of about equal size, each a
range of that order, so neither a first turn that many share nor a conversation with many copies makes a shard larger.
Each shard packs its paths into a BASE and a CHECK array over dense turn numbers and traverses it for the nodes.

Two neighbouring shards share the prefix that the last path of one has in common with the first path of the next, and
nothing else: those few nodes get their totals from all shards that hold them. A shard counts such a node as its own
only if no earlier shard holds it, which makes every total a plain sum over shards.

A path is one row: 24 bytes for each of its turns, texts are not in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.plans.staging import stage

# Turns of the distinct paths in a shard, on average.
SHARD_TURNS = 20_000
# Places tried for the children of one node before they go behind all others.
_TRIES = 64
_NONE = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """BASE and CHECK over turn numbers: the child of s by turn c is t = BASE[s] + c, if CHECK[t] = s. The root is 0.

    BASE may be negative; no child is ever at place 0.
    """

    def __init__(self) -> None:
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0
        self.end = 1  # no place from here on is taken

    def _reach(self, top: int) -> None:
        if top > len(self.check):
            more = max(top, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _place(self, parent: int, codes: np.ndarray, low: int) -> None:
        """Put the children of one node at the first places from `low` on where all of them fit."""
        apart, place = codes - codes[0], low
        for _ in range(_TRIES):
            self._reach(place + int(apart[-1]) + 1)
            if (self.check[place + apart] < 0).all():
                break
            free = np.flatnonzero(self.check[place + 1 : self.end] < 0)
            place = place + 1 + int(free[0]) if len(free) else self.end
        else:
            place = self.end
            self._reach(place + int(apart[-1]) + 1)
        self.base[parent] = place - codes[0]
        self.check[place + apart] = parent
        self.end = max(self.end, place + int(apart[-1]) + 1)

    def insert(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Give nodes their children: pairs in which equal nodes stand together, with rising distinct codes."""
        firsts = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        counts = np.diff(np.append(firsts, len(parents)))
        for first, count in zip(firsts[counts > 1], counts[counts > 1], strict=True):
            free = np.flatnonzero(self.check[: self.end] < 0)
            low = int(free[0]) if len(free) else self.end
            self._place(int(parents[first]), codes[first : first + count], low)
        single = firsts[counts == 1]  # these fill the gaps
        self._reach(self.end + len(single))
        places = np.flatnonzero(self.check < 0)[: len(single)]
        self.base[parents[single]] = places - codes[single]
        self.check[places] = parents[single]
        self.end = max(self.end, int(places[-1]) + 1 if len(places) else 0)

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of the states by the codes, -1 where there is none."""
        to = self.base[states] + codes
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states) & (states >= 0), to, -1)


def dense(levels: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Number turns from 0 in the order of their first level, so that siblings mostly have neighbouring numbers."""
    order = np.argsort(levels, kind="stable")
    kinds, first = np.unique(codes[order], return_index=True)
    number = np.empty(len(kinds), np.int64)
    number[np.argsort(first, kind="stable")] = np.arange(len(kinds))
    return number[np.searchsorted(kinds, codes)]


def packed(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> DoubleArray:
    """The double array of paths in order: path i is flat[starts[i]:][:lengths[i]], and equal prefixes stand together."""
    trie, state, active = DoubleArray(), np.zeros(len(starts), np.int64), np.arange(len(starts))
    for depth in range(int(lengths.max(initial=0))):
        active = active[lengths[active] > depth]
        parents, codes = state[active], flat[starts[active] + depth]
        new = np.ones(len(active), bool)
        new[1:] = (parents[1:] != parents[:-1]) | (codes[1:] != codes[:-1])
        order = np.lexsort((codes[new], parents[new]))
        trie.insert(parents[new][order], codes[new][order])
        state[active] = trie.step(parents, codes)
    return trie


NODES = (
    "shared boolean, node binary, parent_node binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def _chain(path: np.ndarray, depth: int) -> list[bytes]:
    """Names of the nodes of a path from the root down to a depth."""
    names = [hashlib.blake2b(digest_size=16).digest()]
    for key in path[:depth]:
        names.append(hashlib.blake2b(names[-1] + key.tobytes(), digest_size=16).digest())
    return names


def _shard_nodes(table: pa.Table) -> pa.Table:
    """All nodes of one shard; those that other shards hold too are marked and have this shard's part of the totals."""
    table = table.combine_chunks()
    lists = table["keys"].combine_chunks()
    keys = np.frombuffer(b"".join(lists.values.to_pylist()), dtype="V16") if len(lists.values) else np.zeros(0, "V16")
    sizes = table["sizes"].combine_chunks().values.to_numpy()
    starts = lists.offsets.to_numpy()[:-1].astype(np.int64)
    lengths = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    first, weight = table["first"].to_numpy(), table["n"].to_numpy()
    before, after = table["before"][0].as_py(), table["after"][0].as_py()

    codes = np.unique(keys.view("S16"), return_inverse=True)[1] if len(keys) else np.zeros(0, np.int64)
    order = sorted(range(len(starts)), key=lambda i: codes[starts[i] : starts[i] + lengths[i]].tolist())
    starts, lengths, first, weight = starts[order], lengths[order], first[order], weight[order]
    level = np.arange(len(codes)) - np.repeat(lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy()))
    flat = dense(level, codes)
    trie = packed(flat, starts, lengths)

    # along all paths at once, from the root down
    room = len(trie.check)
    n, low = np.zeros(room, np.int64), np.full(room, np.iinfo(np.int64).max)
    size, depth_of, end_of = np.zeros(room, np.int64), np.zeros(room, np.int64), np.full(room, -1, np.int64)
    n[0], low[0] = weight.sum(), first.min()
    state, active, levels = np.zeros(len(starts), np.int64), np.arange(len(starts)), [np.zeros(1, np.int64)]
    end_of[0] = order[0] if lengths[0] == 0 else -1
    left, right = [0], [0]  # nodes of the first and of the last path
    for depth in range(int(lengths.max(initial=0))):
        active = active[lengths[active] > depth]
        at = starts[active] + depth
        to = trie.step(state[active], flat[at])
        state[active] = to
        np.add.at(n, to, weight[active])
        np.minimum.at(low, to, first[active])
        size[to], depth_of[to] = sizes[at], depth + 1
        ended = lengths[active] == depth + 1
        end_of[to[ended]] = np.array(order)[active[ended]]
        levels.append(np.unique(to))
        if active[0] == 0:
            left.append(int(to[0]))
        if active[-1] == len(starts) - 1:
            right.append(int(to[-1]))

    nodes = np.concatenate(levels)
    earlier = np.array(left[: before + 1] if before >= 0 else [], np.int64)  # owned by shards before this one
    owned = np.zeros(room, bool)
    owned[nodes] = True
    owned[earlier] = False
    parents = trie.check[nodes[1:]]
    kids = np.bincount(parents, minlength=room)
    own_kids = np.bincount(parents[owned[nodes[1:]]], minlength=room)
    leaves = np.zeros(room, np.int64)
    leaves[nodes] = kids[nodes] == 0
    if after == lengths[-1]:  # the next shard goes on from the end of the last path
        leaves[right[-1]] = 0
    saved = n * size - np.where(owned, size, 0)
    for level_nodes in levels[:0:-1]:
        np.add.at(leaves, trie.check[level_nodes], leaves[level_nodes])
        np.add.at(saved, trie.check[level_nodes], saved[level_nodes])

    names: dict[int, bytes] = {}
    if before >= 0:
        path = keys[starts[0] : starts[0] + lengths[0]]
        names |= dict(zip(left, _chain(path, before), strict=False))
    if after >= 0:
        path = keys[starts[-1] : starts[-1] + lengths[-1]]
        names |= dict(zip(right, _chain(path, after), strict=False))
    is_root = nodes == 0
    above = np.where(is_root, -1, trie.check[nodes])
    hashes = table["ends"].to_pylist()
    ends = [hashes[i] if i >= 0 else None for i in end_of[nodes]]
    return pa.table(
        {
            "shared": pa.array([s in names for s in nodes.tolist()]),
            "node": pa.array([names.get(s) for s in nodes.tolist()], pa.binary()),
            "parent_node": pa.array([names.get(s) for s in above.tolist()], pa.binary()),
            "conv_id": low[nodes],
            "depth": depth_of[nodes],
            "parent_conv_id": pa.array(low[above], mask=is_root),
            "n_convs": n[nodes],
            "n_children": own_kids[nodes],
            "n_leaves": leaves[nodes],
            "saved_tokens": saved[nodes],
            "ends_sha256": pa.array(ends, pa.string()),
        }
    )


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, conv_id) in order: for each path its smallest conv_id, their number and their hash, one row at a time."""
    now, first, n, sha = None, 0, 0, hashlib.sha256()
    names = ["first", "n", "ends"]
    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if path != now:
                if now is not None:
                    done.append((first, n, sha.hexdigest()))
                now, first, n, sha = path, conv, 0, hashlib.sha256()
            sha.update(b",%d" % conv if n else b"%d" % conv)
            n += 1
        yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], _COPIES)
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (first, n, sha.hexdigest()), strict=True))], _COPIES)


_COPIES = pa.schema([("first", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])


def _common(a: str, b: str) -> Column:
    """How many turns two paths have in common from the start; -1 if there is no second path."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.array_position(same, False)
    return F.when(F.col(b).isNull(), -1).when(first == 0, F.size(a)).otherwise(first - 1).cast("long")


def numbered(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, key, size) of each turn: its place from 1, a 128-bit name of role and text, UTF-8 bytes of the text.

    Turns are in the order of `turn`, nulls first, ties by role and text, so repeated rows follow each other and each
    is a turn. A null role or text is empty. Rows without conv_id take no part.
    """
    said = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    name = F.unhex(F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text").cast("binary")))
    return said.withColumn("place", F.row_number().over(order)).select(
        "conv_id", "place", name.alias("key"), F.octet_length("text").cast("long").alias("size")
    )


def branched(turns: DataFrame, every: int = 5, longest: int = 8) -> DataFrame:
    """(conv_id, turns) of each conversation with its first turns taken from another, as an array of (place, key, size).

    Conversation c starts with the first h turns of conversation c - c % every, all if it has fewer, none if there is no
    such conversation, and goes on with its own turns after the first h; h = crc32(decimal c) % (longest + 1). Every
    conversation has a row, if only with an empty array.
    """
    turns = stage(turns, "turns")
    c = F.col("conv_id")
    convs = stage(turns.groupBy("conv_id").agg(F.count("*").alias("own")), "conversations").select(
        "conv_id",
        (c - c % every).alias("giver"),
        (F.crc32(c.cast("string").cast("binary")) % (longest + 1)).alias("h"),
    )
    whole = turns.join(convs, "conv_id").where((F.col("giver") == c) | (F.col("place") > F.col("h")))
    heads = turns.where((c % every == 0) & (F.col("place") <= longest)).withColumnRenamed("conv_id", "giver")
    taken = convs.where("giver <> conv_id").join(heads, "giver").where("place <= h")
    turn = F.struct("place", "key", "size").alias("turn")
    both = whole.select("conv_id", turn).union(taken.select("conv_id", turn))
    full = both.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    bare = convs.select("conv_id").join(full, "conv_id", "left_anti")
    return full.union(bare.select("conv_id", F.lit(None).cast(full.schema["turns"].dataType))).select(
        "conv_id", F.coalesce("turns", F.array().cast(full.schema["turns"].dataType)).alias("turns")
    )


def whole(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of the numbered turns of each conversation, as it stands."""
    turn = F.struct("place", "key", "size")
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def prefix_nodes(paths: DataFrame) -> DataFrame:
    """A row for each node of the trie of (conv_id, turns): the distinct prefixes, from the empty one on.

    conv_id (the smallest member), depth, parent_conv_id (the parent's, null at the root), n_convs, n_children, n_leaves
    and saved_tokens over the subtree, ends_sha256 over the conversations that end at the node. Conversations without
    turns belong to the root alone. Each conv_id must have one row. An empty table gives an empty result, no root.
    """
    keys = F.col("turns.key")
    name = F.unhex(F.md5(F.array_join(F.transform(keys, F.hex), "").cast("binary")))
    paths = stage(paths.select("conv_id", keys.alias("keys"), F.col("turns.size").alias("sizes"), name.alias("path")), "paths")
    ordered = paths.select("path", "conv_id").repartition("path").sortWithinPartitions("path", "conv_id")
    copies = ordered.mapInArrow(_copies, "first long, n long, ends string")
    distinct = stage(copies.join(paths, F.col("first") == F.col("conv_id")).select("keys", "sizes", "first", "n", "ends"), "distinct-paths")

    turns = distinct.agg(F.sum(F.size("keys"))).first()[0] or 0
    shards = -(-turns // SHARD_TURNS) or 1
    ranged = distinct.repartitionByRange(shards, "keys").withColumn("shard", F.spark_partition_id())
    ranged = stage(ranged, "shards")
    edges = ranged.groupBy("shard").agg(F.min("keys").alias("head"), F.max("keys").alias("tail"))
    beside = Window.orderBy("shard")  # over one row per shard
    edges = edges.withColumns({"last": F.lag("tail").over(beside), "next": F.lead("head").over(beside)})
    edges = edges.select("shard", _common("head", "last").alias("before"), _common("tail", "next").alias("after"))
    parts = stage(ranged.join(edges, "shard").groupBy("shard").applyInArrow(_shard_nodes, NODES), "trie-nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    shared = parts.where("shared").groupBy("node", "parent_node", "depth")
    shared = stage(shared.agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256")), "shared-nodes")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    own = parts.where("not shared")
    below = own.where("parent_node is not null").drop("parent_conv_id").unionByName(shared, allowMissingColumns=True)
    above = shared.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    below = below.join(above, "parent_node", "left")
    nodes = own.where("parent_node is null").select(*columns).union(below.select(*columns))
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))
