import hashlib
import random
import re

from tests.conftest import rows as collected

from stallbook.llm import secrets
from stallbook.llm.trigrams import needed

from .conftest import awkward

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def brute(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= 32])


def test_base_spans_match_a_plain_version(documents):
    rng = random.Random(6)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIkey", " ", "=", ":", '"', "'", "abcdefgh", "é", "🎉", "x1/", "AKIA", "ABCDEFGH1234", "0123456789abcdef", "\n", "-"]
    texts = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))) for i in range(600)] + [(1000, None)]
    found = {r["doc_id"]: r for r in collected(secrets.digested(secrets.scanned(documents(texts))))}
    for i, text in texts:
        spans = brute(text or "")
        plain = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert found[i]["base_sha256"] == hashlib.sha256(plain.encode()).hexdigest(), text
        assert [found[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[1] == n for s in spans) for n in range(3)]


def test_other_rules_add_spans(documents):
    token = "ghp_" + "aB3" * 12
    text = f"see {token} and -----BEGIN RSA PRIVATE KEY----- xoxb-1234567890-abc"
    found = collected(secrets.scanned(documents([(1, text)])))[0]["spans"]
    assert [s["kind"] for s in found] == ["github", "private_key", "slack"]
    assert text[found[0]["start"] : found[0]["end"]] == token


def test_every_match_satisfies_its_trigram_query():
    samples = {
        r"ab(cd|efg)?h[xy]z": ["abcdhxz", "abefghyz", "abhxz"],
        r"(foo|bar)+baz": ["foobaz", "barfoobaz"],
        r"k[0-9]{3}lmn.*op?q": ["k123lmnoq", "k000lmn--opq"],
        r"[aA][bB][cC]D": ["abcD", "ABCD"],
    }
    for pattern, texts in samples.items():
        for text in texts:
            assert re.search(pattern, text)
            query = needed(pattern)
            grams = {text.lower()[i : i + 3] for i in range(len(text))}
            assert not query or any(q <= grams for q in query), (pattern, text)
    assert needed("[0-9a-f]{32,}") == [] and needed("ab") == []
    assert needed("abcd|xyz") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]


def test_only_texts_that_satisfy_a_query_are_candidates(documents):
    frame = documents([(1, "my Password = 12345678"), (2, "pass the word"), (3, "AKIAX"), (4, None)])
    found = {r["doc_id"]: r["rules"] for r in collected(secrets.candidates(frame, secrets.RULES, "text", ["doc_id"]))}
    assert found == {1: ["assign"], 3: ["access"]}


def test_no_python_in_the_plan(documents, capsys):
    secrets.digested(secrets.scanned(documents([(1, "a")]))).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_awkward_rows_and_empty_table(documents):
    found = collected(secrets.digested(secrets.scanned(documents(awkward()))))
    assert len(found) == 10 and all(r["spans"] == "" for r in found)
    assert collected(secrets.scanned(documents([]))) == []


def test_texts_of_many_matches(documents):
    rng, counts = random.Random(8), (255, 256, 257, 511, 512, 513, 1300)
    texts = [(n, "é ".join(f"AKIA{'X' * rng.randint(8, 16)}" + rng.choice(["", " \U0001f511", "\n"]) for _ in range(n))) for n in counts]
    rule = secrets.RULES[1]
    found = {r["doc_id"]: r["spans"] for r in collected(secrets.scanned(documents(texts), rules=(rule,)))}
    for n, text in texts:
        expected = [m.span() for m in re.finditer(rule.pattern, text) if len(m[0]) >= rule.least]
        assert [(s["start"], s["end"]) for s in found[n]] == expected and 0 < len(expected) < n
