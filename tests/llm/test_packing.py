import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tests.conftest import rows as collected
from tokenizers import Tokenizer

from stallbook.llm.packing import Limits, packed
from stallbook.llm.tokens import WordTokenizer

from .conftest import awkward

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


ODD = [
    "<|endoftext|> A<|STARTOFTEXT|>b <|startoftext|>",
    "á ́x \x01 y\x01z İstanbul ΑΣ ΑΣ.",
    "KK x\x85w \x1cq\x1d",
    "'S it's IT'S don't ' l'amour d'été «x»",
    "日本語 テキスト🎉🎉 ªº²½ a1b22 É.À ŒUVRE …—x ßẞ _a_b a\xadb x\xa0y",
    "",
    "  \n ",
]


def test_remembered_words_give_the_tokenizers_ids(whole):
    rng, words = random.Random(1), WordTokenizer(PATH)
    texts = ODD + ["".join(rng.choice("aB é.,'1²\n<|ÀΣ_-") for _ in range(60)) for _ in range(300)]
    for text in texts * 2:
        assert words.ids(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids


def checked(pieces, texts, whole, limits):
    """Every id is in one piece, no limit is broken, and a sequence is full or a power of two long."""
    expected = sorted((key, whole.encode(t or "", add_special_tokens=False).ids + [2]) for key, t in texts)
    by_document, by_sequence = {}, {}
    for p in pieces:
        by_document.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for key, ids in expected:
        at = 0
        for p in sorted(by_document[key], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part)
            at += p["length"]
        assert at == len(ids)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= limits.tokens and len(sequence) <= limits.segments
        assert sum(p["loss_tokens"] for p in sequence) <= limits.loss_tokens
        assert at == limits.tokens or at & (at - 1) == 0


@pytest.mark.parametrize("limits", [Limits(), Limits(tokens=48, segments=3, loss_tokens=40)])
def test_packs_all_within_limits(documents, whole, limits):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["stone", "é", "rivers,", "x"]) for _ in range(rng.choice([0, 1, 2, 9, 60, 400])))) for i in range(150)]
    checked(collected(packed(documents(texts), PATH, limits)), texts, whole, limits)


def test_prompt_tokens_bear_no_loss(spark):
    frame = spark.createDataFrame([(1, "a b c", "d e"), (2, None, "f"), (3, "g", None)], "doc_id long, prompt string, text string")
    found = collected(packed(frame, PATH, prompt="prompt"), "doc_id")
    assert [(r["doc_tokens"], r["loss_tokens"]) for r in found if r["doc_id"] != 1] == [(2, 2), (2, 1)]
    assert sum(r["loss_tokens"] for r in found if r["doc_id"] == 1) == 3


def test_a_prompt_longer_than_a_sequence_is_cut_at_the_loss_limit(spark):
    frame = spark.createDataFrame([(1, "a " * 100, "b " * 100)], "doc_id long, prompt string, text string")
    found = collected(packed(frame, PATH, Limits(64, 8, 16), prompt="prompt"))
    assert sum(r["length"] for r in found) == 201 and sum(r["loss_tokens"] for r in found) == 101
    totals = {}
    for r in found:
        totals[r["sequence_id"]] = totals.get(r["sequence_id"], 0) + r["loss_tokens"]
    assert max(totals.values()) <= 16


def test_awkward_rows(documents):
    found = collected(packed(documents(awkward()), PATH).drop("sequence_id"))
    assert sum(r["length"] for r in found if r["doc_id"] == 1) == 1
    assert {r["doc_id"] for r in found} == {1, 2, 3, 4, 5, 6, None, 8, 9}


def test_empty_table(documents):
    assert collected(packed(documents([]), PATH)) == []
