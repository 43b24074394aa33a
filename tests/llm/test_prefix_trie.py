import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stallbook.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, branch=True):
    """The nodes by brute force over all prefixes."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        giver = c - c % 5 if c >= 0 else c + -c % 5  # towards zero
        full[c] = own.get(giver, [])[:h] + turns[h:] if branch else turns
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    result = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        ends = sorted(c for c in convs if len(full[c]) == len(node))
        leaves = [m for m in below if not any(len(o) == len(m) + 1 and o[: len(m)] == m for o in below)]
        result.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(m) == len(node) + 1 for m in below),
                len(leaves),
                sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(result, key=str)


def got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def nodes(spark, rows, branch=True):
    turns = prefix_trie.numbered(spark.createDataFrame(rows, SCHEMA))
    return prefix_trie.prefix_nodes(prefix_trie.branched(turns) if branch else prefix_trie.whole(turns))


def talk(n, seed=5, turns=6, kinds=3):
    rng = np.random.default_rng(seed)
    return [
        (c, t, ["user", "assistant"][t % 2], "é" * int(rng.integers(0, kinds)))
        for c in range(n)
        for t in range(int(rng.integers(1, turns)))
    ]


@pytest.mark.parametrize("size", [20_000, 40, 7])
def test_equals_brute_force_at_any_shard_size(spark, monkeypatch, size):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", size)
    rows = talk(120)
    assert got(nodes(spark, rows)) == plain(rows)
    assert got(nodes(spark, rows, branch=False)) == plain(rows, branch=False)


def test_hot_first_turn_copies_and_a_path_that_ends_between_shards(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 30)
    rows = [(c, 0, "user", "hello") for c in range(0, 400, 2)]  # copies of a path that others continue
    rows += [(c, t, "user", "hello" if t == 0 else f"{c * t}") for c in range(1, 200, 2) for t in range(3)]
    rows += [(1001, t, "user", str(t)) for t in range(300)]
    rows += [(1002, t, "user", str(t if t < 250 else -t)) for t in range(300)]
    assert got(nodes(spark, rows, branch=False)) == plain(rows, branch=False)


def test_nulls_ties_repeated_rows_and_empty_conversations(spark):
    rows = [
        (0, 1, "user", "b"), (0, None, None, "a"), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 2, "", None),
        (None, 0, "user", "nobody's"), (3, 0, "user", "x" * 100_000), (4, 0, None, None), (17, 0, "user", "a"), (-7, 5, "user", "b"),
    ]
    assert got(nodes(spark, rows, branch=False)) == plain(rows, branch=False)
    assert got(nodes(spark, rows)) == plain(rows)


def test_conversations_without_turns_are_members_of_the_root(spark):
    rows = [(c, 0, "user", str(c)) for c in range(6, 30) if c % 5]
    expected = plain(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in expected)
    assert got(nodes(spark, rows)) == expected


def test_empty_table_and_clashing_columns(spark):
    assert nodes(spark, []).count() == 0
    frame = spark.createDataFrame([(1, 0, "u", "t", 9, 9, "k", 3)], SCHEMA + ", place int, size int, key string, n long")
    assert got(prefix_trie.prefix_nodes(prefix_trie.whole(prefix_trie.numbered(frame)))) == plain([(1, 0, "u", "t")], branch=False)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=6), min_size=1, max_size=60))
def test_double_array_holds_exactly_the_prefixes(paths):
    paths = sorted(set(map(tuple, paths)))
    flat = np.array([c for p in paths for c in p], np.int64)
    lengths = np.array([len(p) for p in paths], np.int64)
    trie = prefix_trie.packed(flat, np.cumsum(lengths) - lengths, lengths)
    prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}

    def walk(path):
        state = np.zeros(1, np.int64)
        for c in path:
            state = trie.step(state, np.array([c]))
        return int(state[0])

    assert len({walk(p) for p in prefixes}) == len(prefixes) == int((trie.check >= 0).sum())
    for p in prefixes:
        assert walk(p) >= 0
        for c in range(42):
            assert (walk((*p, c)) >= 0) == ((*p, c) in prefixes)
