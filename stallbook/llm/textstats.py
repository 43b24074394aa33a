"""Counts of many texts at once that quality rules use."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.words import NOT_BLANK, U64, Block, blocks, find_words, mix, runs

WINDOW = 5
# [#*$%&|<>]
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_NOT_NEWLINE = np.ones(256, dtype=bool)
_NOT_NEWLINE[0x0A] = False
_ROW = U64(0xD6E8FEB86659FD93)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags each row has."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _met_before(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries repeat an earlier one of their row, and which have an equal one at all."""
    again, shared = np.zeros(len(rows), dtype=bool), np.zeros(len(rows), dtype=bool)
    if len(rows) > 1:
        keys = mix(hashes + rows.astype(U64) * _ROW)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        same = ranked[1:] == ranked[:-1]
        again[order[1:][same]] = True
        shared[order[1:][same]] = True
        shared[order[:-1][same]] = True
    return again, shared


def _counts(block: Block) -> list[np.ndarray]:
    data, offsets = block.data, block.offsets
    found = find_words(block)
    n_words = found.counts()
    n_symbols = _per_row(SYMBOLS[data], offsets)
    points = _per_row(NOT_BLANK[data] & ((data & 0xC0) != 0x80), offsets)

    lines = find_words(block, _NOT_NEWLINE)
    wordy = np.searchsorted(found.starts, lines.ends) > np.searchsorted(found.starts, lines.starts)
    line_row = lines.row_of()
    n_lines = np.bincount(line_row[wordy], minlength=block.rows)
    repeats, _ = _met_before(line_row[wordy], lines.hashes[wordy])
    n_dup_lines = np.bincount(line_row[wordy][repeats], minlength=block.rows)

    word_row = found.row_of()
    windows = runs(found.hashes, WINDOW)
    valid = np.flatnonzero(word_row[: len(windows)] == word_row[WINDOW - 1 :])
    _, shared = _met_before(word_row[valid], windows[valid])
    change = np.zeros(len(word_row) + 1, dtype=np.int64)
    np.add.at(change, valid[shared], 1)
    np.add.at(change, valid[shared] + WINDOW, -1)
    covered = np.cumsum(change)[:-1] > 0
    n_repeat = np.bincount(word_row[covered], minlength=block.rows)
    return [n_words, points, n_symbols, n_lines, n_dup_lines, n_repeat]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def counted(documents: DataFrame, carried: tuple[str, ...], text: str = "text") -> DataFrame:
    """The carried columns of each row with the counts of its text.

    n_words: runs without white space; word_chars: code points in them; n_symbols: characters of [#*$%&|<>]; n_lines:
    lines with a word; n_dup_lines: those equal to an earlier one; n_repeat_words: words in windows of five words that
    occur twice or more in the text. A null text counts as empty.
    """
    fields = documents.select(*carried).schema
    names = [*carried, *COUNTS]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(len(carried))):
                kept = [batch.column(i).slice(block.first, block.rows) for i in range(len(carried))]
                counts = [pa.array(c, pa.int64()) for c in _counts(block)]
                yield pa.RecordBatch.from_arrays([*kept, *counts], names)

    schema = fields
    for name in COUNTS:
        schema = schema.add(name, "long")
    return documents.select(*carried, F.col(text).cast("string").alias("__text")).mapInArrow(rows_of, schema)
