import hashlib
import random
import re

import numpy as np
import pytest
from tests.conftest import rows as collected

from stallbook.llm import crf, pii

from .conftest import awkward

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_patterns_match_a_plain_version():
    rng = random.Random(1)
    parts = ["a", "@", ".", "-", "1", "25", "+", " ", "(", ")", "b.c", "4111111111111111", "9", "é", "_", "%", "256", "0"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert pii.patterns(text) == brute(text), text


def test_patterns_are_linear_in_awkward_texts():
    for text in ("1" * 400_000, "a" * 400_000 + "@", "+1" * 200_000, "1.1." * 100_000, "a@" * 200_000):
        pii.patterns(text)


def exact(unary, links, kinds, edges):
    n, k = unary.shape
    total = np.zeros((n, k))
    for code in range(k**n):
        y = [(code // k**i) % k for i in range(n)]
        weight = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(edges[e] for (a, b), e in zip(links, kinds) if y[a] == y[b]))
        for i in range(n):
            total[i, y[i]] += weight
    return total / total.sum(axis=1, keepdims=True)


def test_messages_give_exact_marginals_on_a_tree_and_near_ones_on_a_loop():
    rng = np.random.default_rng(1)
    unary, edges = rng.normal(size=(5, 3)), np.array([0.7, 1.5])
    tree = np.array([[0, 1], [1, 2], [1, 3], [3, 4]])
    kinds = np.array([0, 1, 0, 1])
    assert np.allclose(crf.marginals(unary, tree, kinds, edges, 60), exact(unary, tree, kinds, edges), atol=1e-4)
    loop, kinds = np.array([[0, 1], [1, 2], [2, 3], [3, 4], [0, 4]]), np.array([0, 0, 0, 0, 1])
    assert np.abs(crf.marginals(unary, loop, kinds, edges, 60) - exact(unary, loop, kinds, edges)).max() < 0.1


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(300):
        number = f"({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        kind = i % 5
        text = [f"call +1 {number} now", f"mail x{i}@y.example today", f"host 10.0.{i % 200}.7 is up", f"version {i % 9}.{i % 7} of {i}", "no data"][kind]
        rows.append((i, text))
    return rows


@pytest.fixture(scope="module")
def field(documents):
    return pii.fitted(documents(corpus()), "doc_id", "text")


def test_a_distant_repetition_gets_the_label_of_the_match(documents):
    rows = corpus() + [(999, "call +1 (269) 555-3296 now. " + "and so on " * 200 + "or dial (269) 555-3296 again, 7 times")]
    found = {r["doc_id"]: r for r in collected(pii.found_in(documents(rows)))}
    text = rows[-1][1]
    start = text.rindex("(269)")
    assert found[999]["n_phone"] == 1 and found[999]["n_added"] == 1
    assert found[999]["spans"].split(",")[-1] == f"phone:{start}:{start + len('(269) 555-3296')}"
    for i, text in rows:
        assert found[i]["base_sha256"] == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(brute(text))).encode()).hexdigest()
    assert all(found[i]["spans"] == "" for i, t in rows if t == "no data" or t.startswith("version"))


@pytest.mark.parametrize("bare", ["(269) 555-3296", "269-555-3296", "2695553296", "269 555 3296", "269.555.3296", "555-3296"])
@pytest.mark.parametrize("n", [1, 5, 30, 200])
def test_all_repetitions_get_the_label_however_written(field, n, bare):
    text = "call +1 (269) 555-3296 now. " + f"and so on, then {bare} in place of 41 or 2024. " * n
    base, added = pii.spans_of(text, field)
    starts = [m.start() for m in re.finditer(f"then {re.escape(bare)}", text)]
    assert len(base) == 1 and added == [(3, s + 5, s + 5 + len(bare)) for s in starts]


def test_repetitions_of_a_rare_form_between_others(field):
    text = "call +1 (269) 555-3296 now. " + "".join(f"then {b} on. " for b in ("269-555-3296", "2695553296", "999-555-3290", "(269) 555-3296") * 40)
    _, added = pii.spans_of(text, field)
    found = [text[a:b] for k, a, b in added if k == 3]
    assert [f for f in found if "3290" not in f] == ["269-555-3296", "2695553296", "(269) 555-3296"] * 40


def test_messages_pass_long_chains():
    n = 300
    unary = np.zeros((n, 2))
    unary[0, 1] = 50.0
    links, kinds = np.array([[i, i + 1] for i in range(n - 1)]), np.ones(n - 1, dtype=int)
    p = crf.marginals(unary, links, kinds, np.array([0.0, 6.0]))
    # each link keeps tanh(weight / 2) of what is known
    assert np.allclose(p[:, 1] - 0.5, 0.5 * np.tanh(3.0) ** np.arange(n), atol=0.02)


def test_positions_count_code_points(documents):
    found = collected(pii.found_in(documents([(1, "🎉é a@b.cd"), (2, None), (3, "nothing")])), "doc_id")
    assert [r["spans"] for r in found] == ["email:3:9", "", ""]


def test_awkward_rows_and_empty_table(documents):
    assert len(collected(pii.found_in(documents(awkward())))) == 10
    assert collected(pii.found_in(documents([]))) == []


def test_the_sample_stays_bounded_under_hot_keys_and_texts(documents, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_DOCS", 400)
    hot_key = [(5, f"call {i}") for i in range(2000)]
    hot_row = [(6, "mail a@b.org")] * 2000
    others = [(i, f"number {i}") for i in range(100, 2100)]
    drawn = pii.sample(documents([*hot_key, *hot_row, *others, (None, None), (None, "no digit")]), "doc_id", "text").collect()
    assert 150 < len(drawn) <= 400
    for key, most in ((5, 180), (6, 1)):
        assert sum(r["key"] == key for r in drawn) <= most
    assert all(r["text"] for r in drawn)
    few = pii.sample(documents([(1, "a 1"), (1, "a 1"), (None, "a 1"), (2, "none")]), "doc_id", "text")
    assert sorted((r["key"] or 0, r["text"]) for r in few.collect()) == [(0, "a 1"), (1, "a 1")]
