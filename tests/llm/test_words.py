import random
import re

import pyarrow as pa
import pytest

from stallbook.llm import textstats, words

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def all_words(texts, limit):
    found = []
    for block in words.blocks(pa.chunked_array([texts]), limit):
        w = words.find_words(block)
        for low, high in zip(w.row_first[:-1], w.row_first[1:]):
            found.append([bytes(block.data[a:b]).decode() for a, b in zip(w.starts[low:high], w.ends[low:high])])
    return found


@pytest.mark.parametrize("limit", [1, 7, 1 << 20])
def test_words_are_those_of_the_pattern(limit):
    texts = ["a bb c", None, "", " ", "été\n\nx\x0b", "日本 語", "z" * 500, "q"]
    assert all_words(texts, limit) == [SPLIT.findall(t or "") for t in texts]


def test_equal_words_and_only_those_have_equal_hashes():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abéc") for _ in range(rng.randint(1, 200))) for _ in range(400)]
    text = " ".join(rng.choice(vocabulary) for _ in range(3000))
    block = next(words.blocks(pa.array([text])))
    w = words.find_words(block)
    by_hash = {}
    for h, word in zip(w.hashes, text.split()):
        assert by_hash.setdefault(int(h), word) == word
    assert len(by_hash) == len(set(text.split()))


def test_short_texts_are_one_shingle_of_their_own_length():
    block = next(words.blocks(pa.array(["a b", "a b c", "b a", "", "a"])))
    sets = words.shingles(words.find_words(block), 3)
    assert [len(s) for s in sets] == [1, 1, 1, 0, 1]
    assert len({int(s[0]) for s in sets if len(s)}) == 4


def plain_counts(text):
    text = text or ""
    found = SPLIT.findall(text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if SPLIT.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(found) - 4):
        places.setdefault(tuple(found[i : i + 5]), []).append(i)
    covered = {i + j for at in places.values() if len(at) > 1 for i in at for j in range(5)}
    return [len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), lines, dup, len(covered)]


@pytest.mark.parametrize("limit", [40, 1 << 20])
def test_counts_match_a_plain_version(limit):
    rng = random.Random(3)
    texts = [None, "", "\n\n", "a\na\n a\n"]
    for _ in range(200):
        texts.append("".join(rng.choice(["a", "b", "é", " ", " ", "\n", "#", "<|"]) for _ in range(rng.randint(0, 80))))
    got = []
    for block in words.blocks(pa.array(texts), limit):
        got += [list(map(int, row)) for row in zip(*textstats._counts(block))]
    assert got == [plain_counts(t) for t in texts]
