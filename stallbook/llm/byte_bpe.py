"""Byte-level BPE with the tiktoken library and a local rank file: texts to ids, and ids back to raw bytes.

The splitting pattern is matched by a backtracking engine whose stack a long text can exhaust. A long text is therefore
cut first, at places no match of the pattern can span: before a blank that follows something else than white space. A
stretch without such a place is split by the `regex` module instead, match by match, and each match is encoded alone.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters given to the library at once.
SLICE = 1 << 13
# Ids in an Arrow batch handed back to Spark, beyond those of the text that reaches it.
_BATCH_IDS = 1 << 20
# No part of a pattern of this family goes over such a place: a blank only begins a match or belongs to white space.
_SAFE = regex.compile(r"(?<=[^\s])(?=[ \n])")


class ByteBpe:
    """An encoding of one rank file (lines of a base64 token and its rank) and one splitting pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)

    def pieces(self, text: str, limit: int = SLICE) -> Iterator[str]:
        """The text in pieces that have the matches of the whole text; a piece goes on until it may be cut."""
        low = 0
        while len(text) - low > limit:
            found = _SAFE.search(text, low + limit)
            if found is None:
                break
            yield text[low : found.start()]
            low = found.start()
        yield text[low:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= SLICE:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for piece in self.pieces(text):
            if len(piece) <= 2 * SLICE:
                ids += self.encoding.encode_ordinary(piece)
            else:
                for match in self.pattern.finditer(piece):
                    ids += self.encoding._encode_single_piece(match.group())
        return ids

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids end to end; cut inside a character, they are no valid text, which is no error."""
        return self.encoding.decode_bytes(ids)


_loaded: dict[tuple[str, str], ByteBpe] = {}


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One per Python worker, file and pattern."""
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = ByteBpe(path, pattern)
    return _loaded[path, pattern]


def encoded(documents: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The documents without their text, with its ids, an array of int, in the column named by `ids`.

    Whole texts of any length are encoded and no string is special. A null or empty text has no ids. Rows and their
    other columns, nulls and repeated rows among them, stay as they are; a column that is already named `ids` is
    replaced. An empty table gives an empty result. `path` is a rank file that every executor can open.
    """
    others = [c for c in documents.columns if c not in (text, ids)]
    plain = documents.select(*others, F.col(text).cast("string").alias(text))
    schema = T.StructType([*plain.schema.fields[:-1], T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            first, parts, offsets = 0, [], [0]
            for i, value in enumerate(batch.column(len(others))):
                found = bpe.encode(value.as_py() or "")
                parts.append(np.array(found, dtype=np.int32))
                offsets.append(offsets[-1] + len(found))
                if offsets[-1] >= _BATCH_IDS or i + 1 == batch.num_rows:
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(parts)))
                    own = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([*own.columns[: len(others)], lists], schema.names)
                    first, parts, offsets = i + 1, [], [0]

    return plain.mapInArrow(rows_of, schema)


def decoded(tokens: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "data") -> DataFrame:
    """The rows with the raw bytes of their ids in the binary column named by `data`, which replaces one of that name.

    Null ids give null, no ids give no bytes. A null among the ids or an id the rank file lacks is an error. An empty
    table gives an empty result.
    """
    plain = tokens.drop(data)
    where = plain.columns.index(ids)
    schema = T.StructType([*plain.schema.fields, T.StructField(data, T.BinaryType())])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            first, found, size = 0, [], 0
            for i, value in enumerate(batch.column(where)):
                found.append(bpe.decode(value.values.to_pylist()) if value.is_valid else None)
                size += len(found[-1] or b"")
                if size >= 4 * _BATCH_IDS or i + 1 == batch.num_rows:
                    own = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, pa.binary())], schema.names)
                    first, found, size = i + 1, [], 0

    return plain.mapInArrow(rows_of, schema)


def digested(tokens: DataFrame, key: str = "doc_id", ids: str = "ids", data: str = "data") -> DataFrame:
    """The key, n_tokens, and the SHA-256 of the decimal ids joined by commas and of the decoded bytes."""
    listed = F.concat_ws(",", F.col(ids).cast("array<string>"))
    return tokens.select(
        key,
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(data, 256).alias("decoded_sha256"),
    )
