import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stallbook.llm import byte_bpe
from stallbook.llm.byte_bpe import ByteBpe

from .conftest import awkward

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH, PATTERN)


def plain(bpe, text):
    """Match by match, each alone."""
    return [i for m in bpe.pattern.finditer(text) for i in bpe.encoding._encode_single_piece(m.group())]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sa1. \x1c　")), max_size=200))
def test_pieces_have_the_matches_of_the_whole(text):
    bpe = byte_bpe.byte_bpe(PATH, PATTERN)
    pieces = list(bpe.pieces(text, limit=3))
    assert "".join(pieces) == text
    assert [i for p in pieces for i in bpe.encoding.encode_ordinary(p)] == bpe.encoding.encode_ordinary(text)


@pytest.mark.parametrize(
    "text",
    ["a b's  c\n\n d " * 4000, "x" * 100_000, " " * 200_000 + "a", "\n" * 50_000, "日本語。" * 9000, "don't, it's 1234567890" * 3000, "é🎉 " * 9000],
)
def test_long_texts_equal_match_by_match(bpe, text):
    ids = bpe.encode(text)
    assert ids == plain(bpe, text)
    assert bpe.decode(ids) == text.encode()


def test_cut_characters_decode_to_raw_bytes(bpe):
    ids = bpe.encode("🎉🦜")
    assert b"".join(bpe.decode([i]) for i in ids) == "🎉🦜".encode()
    with pytest.raises(UnicodeDecodeError):
        bpe.decode(ids[:1]).decode()


def test_strings_of_special_tokens_are_ordinary(bpe):
    assert bpe.decode(bpe.encode("<|endoftext|>")) == b"<|endoftext|>" and len(bpe.encode("<|endoftext|>")) > 1


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_awkward_rows(spark, documents, bpe):
    rows = awkward()
    tokens = byte_bpe.encoded(documents(rows), PATH, PATTERN)
    found = byte_bpe.digested(byte_bpe.decoded(tokens, PATH, PATTERN)).collect()
    expected = []
    for key, text, *_ in rows:
        ids = plain(bpe, text or "")
        expected.append((key, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_empty_table_clashing_names_and_null_ids(spark, documents):
    assert byte_bpe.decoded(byte_bpe.encoded(documents([]), PATH, PATTERN), PATH, PATTERN).count() == 0
    odd = spark.createDataFrame([("a b", 1, "x", "dot", 7)], "text string, ids int, data string, b string, n_tokens int")
    tokens = byte_bpe.encoded(odd, PATH, PATTERN)
    assert tokens.columns == ["data", "b", "n_tokens", "ids"]
    (row,) = byte_bpe.decoded(tokens, PATH, PATTERN).collect()
    assert bytes(row["data"]) == b"a b" and row["b"] == "dot" and row["n_tokens"] == 7
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    got = {r.doc_id: r["data"] for r in byte_bpe.decoded(nothing, PATH, PATTERN).collect()}
    assert got[1] is None and bytes(got[2]) == b""


def test_batches_of_many_ids(spark, documents, monkeypatch, bpe):
    rows = [(i, "some words here " * 40_000) for i in range(8)]
    tokens = byte_bpe.encoded(documents(rows, partitions=1), PATH, PATTERN)
    expected = len(plain(bpe, rows[0][1]))
    assert [len(r.ids) for r in tokens.collect()] == [expected] * 8
