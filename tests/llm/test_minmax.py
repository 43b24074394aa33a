import random
import re

import pytest
from tests.conftest import rows as collected

from stallbook.llm import minmax

from .conftest import awkward

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, percent=80):
    sets = {i: shingles(t, width) for i, t in rows}
    best = {i: i for i in sets}

    def root(i):
        while best[i] != i:
            i = best[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                best[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("width", [2, 5])
def test_components_match_all_pairs(documents, width):
    rng = random.Random(width)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 120))] for _ in range(25)]
    rows = []
    for words in base:
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, len(words) // 20 + 1])):
                copy[rng.randrange(len(copy))] = f"w{rng.randint(0, 400)}"
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in collected(minmax.near_duplicates(documents(rows), width))}
    assert found == brute(rows, width)


def test_chains_in_one_bucket_are_followed(documents):
    """A large group that drifts: neighbours are linked, distant ones are not, and the head settles only a part."""
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(120):
        rows.append((1000 - i, " ".join(words)))
        words = [*words[2:], f"n{i}a", f"n{i}b"]
    found = {r["component_id"] for r in collected(minmax.near_duplicates(documents(rows), 2))}
    assert found == {v for _, v in brute(rows, 2).values()}


def test_blocks_of_open_sets_find_links_between_components(spark, monkeypatch):
    monkeypatch.setattr(minmax, "_BLOCK", 2)
    sets = [(i, list(range(100 * (i // 3), 100 * (i // 3) + 20 + i % 3))) for i in range(12)]
    frame = spark.createDataFrame([(bytes([i]), m) for i, m in sets], "id binary, members array<long>")
    rest = spark.createDataFrame([(b"h", bytes([i]), bytes([i])) for i, _ in sets], "head binary, id binary, component binary")
    got = {(r["a"][0], r["b"][0]) for r in minmax._between(rest, frame, 80).collect()}
    assert got == {(a, b) for a in range(12) for b in range(a + 1, 12) if a // 3 == b // 3}


def test_a_large_component_is_compared_with_the_strangers_only(spark, monkeypatch):
    monkeypatch.setattr(minmax, "_BLOCK", 4)
    dealt = []
    write = minmax.stage
    monkeypatch.setattr(minmax, "stage", lambda frame, label: (out := write(frame, label), dealt.append(out) if label == "open" else None)[0])
    members = [bytes([0, i]) for i in range(100)] + [bytes([1]), bytes([2])]
    sets = spark.createDataFrame([(m, [1000 * i + k for k in range(9)]) for i, m in enumerate(members)], "id binary, members array<long>")
    rest = [(b"h", m, b"large" if len(m) == 2 else m) for m in members]
    found = minmax._between(spark.createDataFrame(rest, "head binary, id binary, component binary"), sets, 80)
    assert found.count() == 0
    # every member once for the one block of strangers, and the strangers once for each of the 26 blocks
    assert dealt[0].count() == 102 + 2 * 26


def test_a_set_whose_smallest_id_has_another_text_too(documents):
    base = [f"w{i}" for i in range(60)]
    near = [*base[:-1], "x"]
    rows = [(5, "a very different text " * 9), (5, " ".join(base)), (9, " ".join(base)), (11, " ".join(near)), (12, "a very different text " * 9)]
    found = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in collected(minmax.near_duplicates(documents(rows))))
    assert found == [(5, 5, True), (5, 5, True), (9, 5, False), (11, 5, False), (12, 5, False)]


def test_repeated_ids_with_other_texts_equal_brute_force(documents):
    """The classes are those of single texts; each row has the smallest id of its own text's component."""
    rng = __import__("random").Random(8)
    bases = [[f"b{k}w{i}" for i in range(40)] for k in range(6)]
    rows = []
    for i in range(70):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(40)] = f"n{rng.randrange(9)}"
        rows.append((i % 23, " ".join(words)))
    single = brute([(i, text) for i, (_, text) in enumerate(rows)], 2)  # every row a document of its own
    smallest = {}
    for i, (key, _) in enumerate(rows):
        component = single[i][1]
        smallest[component] = min(smallest.get(component, key), key)
    expected = sorted((key, text, smallest[single[i][1]]) for i, (key, text) in enumerate(rows))
    frame = documents(rows)
    found = sorted((r["doc_id"], r["component_id"]) for r in collected(minmax.near_duplicates(frame, 2)))
    assert found == sorted((key, component) for key, _, component in expected)


def test_long_paths_become_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(1, 61), 100, 101, 200]], "id long")
    found = {r["id"]: r["component"] for r in minmax.components(nodes, links).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 200: 200}


def test_awkward_rows(documents):
    found = collected(minmax.near_duplicates(documents(awkward())), "doc_id")
    assert len(found) == 10
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_shingles"] == 0 and by_id[1]["kept"] and by_id[3]["component_id"] == 3
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert by_id[9]["component_id"] == 6 and not by_id[9]["kept"]
    assert by_id[5]["n_shingles"] == 1
    assert sum(r["doc_id"] == 6 and r["kept"] for r in found) == 2


def test_empty_table(documents):
    assert collected(minmax.near_duplicates(documents([]))) == []


def test_foreign_columns_do_not_clash(documents, spark):
    frame = documents([(1, "a b c"), (2, "a b c")])
    for name in ("id", "bucket", "members", "set_key", "bands", "component", "kept"):
        frame = frame.withColumn(name, frame["text"])
    assert {r["component_id"] for r in collected(minmax.near_duplicates(frame, 2))} == {1}
