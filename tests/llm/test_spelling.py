import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stallbook.llm import spelling
from stallbook.llm.acceptors import Acceptor, one_edit_pairs

from .conftest import awkward


def near(u, w):
    if len(u) > len(w):
        u, w = w, u
    if len(u) == len(w):
        return sum(a != b for a, b in zip(u, w, strict=True)) == 1
    return len(w) == len(u) + 1 and any(w[:i] + w[i + 1 :] == u for i in range(len(w)))


def plain_words(rows):
    total = Counter()
    for key, text, *_ in rows:
        for run in spelling.regex.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def plain_variants(words):
    by = {w: [o for o in words if near(w, o)] for w in words}
    form = {}
    for w, others in by.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= 2 * words[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, n, len(by[w]), form.get(w), words.get(form.get(w)), root(w)) for w, n in words.items())


def got(frame):
    return sorted(tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in frame.collect())


words_of = st.lists(st.text(alphabet="abé", max_size=6), max_size=40, unique=True)


@settings(max_examples=200, deadline=None)
@given(words_of)
def test_acceptor_is_exact_and_minimal(words):
    acceptor = Acceptor(sorted(words))
    seen = {}

    def language(state):
        found = {""} if acceptor.final[state] else set()
        for letter, to in acceptor.arcs[state].items():
            found |= {letter + rest for rest in language(to)}
        return frozenset(found)

    assert language(acceptor.root) == set(words)
    for state in range(len(acceptor.arcs)):
        assert seen.setdefault(language(state), state) == state


@settings(max_examples=200, deadline=None)
@given(words_of)
def test_composition_gives_each_pair_once(words):
    pairs = [tuple(sorted(p)) for p in one_edit_pairs(Acceptor(sorted(words)))]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and near(a, b)}


@pytest.mark.parametrize("limit", [2000, 12, 1])
def test_variants_equal_brute_force_at_any_part_size(spark, monkeypatch, limit):
    monkeypatch.setattr(spelling, "PART_WORDS", limit)
    rng = random.Random(limit)
    words = {"".join(rng.choices("abcé", k=rng.randint(5, 9))): rng.randint(3, 60) for _ in range(260)}
    words |= {"commonbeginning" + "".join(rng.choices("ab", k=4)): rng.randint(3, 9) for _ in range(16)}
    words |= {w + w[-1]: 7 for w in list(words)[:40]} | {w[1:] if len(w) > 5 else w: 3 for w in list(words)[:40]}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert got(spelling.variants(frame)) == plain_variants(words)


def test_words_of_awkward_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(spelling, "_COUNTED", 50)
    rng = random.Random(3)
    rows = awkward(40_000) + [(i, " ".join(rng.choice(["Hello", "hallo", "WORLDS", "worlds", "naïveté", "×÷×÷×÷", "four", "x1y2z"]) for _ in range(50))) for i in range(100)]
    expected = plain_words(rows)
    assert {r.word: r.n for r in spelling.counted(documents(rows)).collect()} == expected
    assert got(spelling.variants(spelling.counted(documents(rows)))) == plain_variants(expected)


def test_empty_table_and_clashing_columns(spark, documents):
    assert spelling.variants(spelling.counted(documents([]))).count() == 0
    odd = documents([(1, "words words words")]).selectExpr("*", "'k' as word", "1 as n", "2 as m", "3 as low", "4 as root")
    assert got(spelling.variants(spelling.counted(odd))) == [("words", 3, 0, None, None, "words")]
