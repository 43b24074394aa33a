import random
import re

from tests.conftest import rows as collected

from stallbook.llm import licenses
from stallbook.llm.license_texts import TEMPLATES

from .conftest import awkward


def words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", text.lower())


def brute(text, template, threshold=0.8):
    """Whether any passage of the text reaches the threshold."""
    target = set(zip(words(template), words(template)[1:]))
    w = words(text)
    pairs = list(zip(w, w[1:]))
    for i, first in enumerate(pairs):
        if first in target:
            for j in range(i, len(pairs)):
                part = set(pairs[i : j + 1])
                if 2 * len(part & target) >= threshold * (len(part) + len(target)):
                    return True
    return False


def test_changed_notices_are_found_like_by_all_passages(documents):
    rng = random.Random(4)
    names = ["MIT notice", "Apache-2.0 notice", "GPL-3.0 notice", "CC-BY-NC-4.0 notice", "MPL-2.0"]
    texts, expected = [], set()
    for n in range(120):
        w = TEMPLATES[rng.choice(names)].split()
        for _ in range(rng.randint(0, 4)):
            rng.choice([lambda: w.pop(rng.randrange(len(w))), lambda: w.insert(rng.randrange(len(w)), rng.choice(["the", "of", "new"]))])()
        text = "é some words under the License " + "\n".join(w) + " and more of the text"
        texts.append((n, text))
        expected |= {(n, name) for name in names if brute(text, TEMPLATES[name])}
    found = collected(licenses.scanned(documents(texts), templates={n: TEMPLATES[n] for n in names}))
    assert {(r["doc_id"], r["license"]) for r in found} == expected


def plain_passages(text, template, threshold=0.8):
    """(first word, last word, dice) of the passages: each the best that begins within the first to reach the threshold."""
    target = set(zip(words(template), words(template)[1:]))
    w = words(text)
    pairs = list(zip(w, w[1:]))
    best = {}
    for i, first in enumerate(pairs):
        part, common = set(), 0
        for j in range(i, len(pairs) if first in target else i):
            common += pairs[j] in target and pairs[j] not in part
            part.add(pairs[j])
            dice = 2 * common / (len(part) + len(target))
            if pairs[j] in target and dice >= max(threshold, best.get(i, (0, 0))[0]):
                best[i] = dice, j
    found, i = [], 0
    while i < len(pairs):
        if i in best:
            at = max((k for k in best if i <= k <= best[i][1]), key=lambda k: (best[k][0], -k))
            found.append((at, best[at][1] + 1, best[at][0]))
            i = best[at][1]
        i += 1
    return found


def test_the_best_passage_is_taken(documents):
    for name, least in (("MIT notice", 5), ("MPL-2.0", 20)):
        rng, texts = random.Random(6), []
        w = TEMPLATES[name].split()
        for n in range(60):
            # a part of the notice before, and sometimes after, a changed copy
            copy = [x for x in w if rng.random() > 0.03]
            low = rng.randrange(len(w) - 3)
            parts = [w[low : low + rng.randint(2, 12)], copy, w[: rng.randint(0, 6)] if n % 2 else [], copy if n % 5 == 0 else []]
            texts.append((n, " ".join(x for part in parts for x in ["so", *part])))
        found = collected(licenses.scanned(documents(texts), templates={name: TEMPLATES[name]}))
        expected, later = [], 0
        for n, text in texts:
            places = [m.span() for m in re.finditer(r"[a-z0-9\u0080-\U0010ffff]+", text.lower())]
            for low, high, dice in plain_passages(text, TEMPLATES[name]):
                expected.append((n, places[low][0], places[high][1], round(dice, 9)))
                later += low > 1
        assert sorted((r["doc_id"], r["start"], r["end"], round(r["dice"], 9)) for r in found) == expected
        assert later > least


def test_spans_are_the_licence(documents):
    text = "Ä 🎉 words before. " + TEMPLATES["MIT"] + " words after. " + TEMPLATES["MIT"]
    found = collected(licenses.scanned(documents([(1, text)])), "start")
    assert [r["license"] for r in found] == ["MIT", "MIT"] and all(r["dice"] == 1.0 for r in found)
    for r in found:
        assert text[r["start"] : r["end"]].startswith("Permission is") and text[r["start"] : r["end"]].endswith("THE SOFTWARE")


def test_long_texts_name_their_own_licence(documents):
    for name in ("ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0", "Unlicense"):
        found = collected(licenses.scanned(documents([(1, TEMPLATES[name])])))
        assert name in {r["license"] for r in found if r["dice"] == 1.0}


def test_awkward_rows_and_empty_table(documents):
    assert collected(licenses.scanned(documents(awkward()))) == []
    assert collected(licenses.scanned(documents([]))) == []
