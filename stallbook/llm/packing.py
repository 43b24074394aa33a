"""Vector bin packing of training examples into sequences.

An example asks for three things at once: tokens, one segment, and loss-bearing tokens. A sequence has a limit for
each. One sequence is filled at a time, always with the waiting example that has the largest dot product of its demand
and the room left (both as shares of the limits) among those that fit. When none fits, the longest waiting example is
cut to fill the rest. A sequence that ends below the token limit, because its segments or the examples ran out, is cut
back to a power of two, so that it needs no padding either.

Every task packs the rows of its own input partition with a bounded number of examples waiting: nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.tokens import REMEMBERED, word_tokenizer

END_ID = 2
# Examples that wait in a task; packing starts at this number and stops at half of it.
WAITING = 512
# Sequences that a task may number.
_NUMBERS = 1 << 40


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 128
    loss_tokens: int = 4096


@dataclass
class Piece:
    """Some tokens of an example: all its tokens, the prompt's share of them, and where the piece begins and ends."""

    key: int | None
    ids: np.ndarray
    prompt: int
    start: int
    stop: int

    @property
    def length(self) -> int:
        return self.stop - self.start

    @property
    def loss(self) -> int:
        return self.stop - min(max(self.start, self.prompt), self.stop)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        middle = self.start + length
        return (
            Piece(self.key, self.ids, self.prompt, self.start, middle),
            Piece(self.key, self.ids, self.prompt, middle, self.stop),
        )

    def longest(self, tokens: int, loss: int) -> int:
        """How many tokens from the start fit."""
        free = max(self.prompt - self.start, 0)
        return min(tokens, self.length, free + loss)


class Packer:
    """Packs the examples of one task; `filled` holds finished sequences as lists of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.full = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=float)
        self.waiting: list[Piece] = []
        self.demand = np.zeros((2 * WAITING, 3))
        self.filled: list[list[Piece]] = []

    def _wait(self, piece: Piece) -> None:
        n = len(self.waiting)
        if n == len(self.demand):
            self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
        self.waiting.append(piece)
        self.demand[n] = (piece.length, 1, piece.loss)

    def _take(self, i: int) -> Piece:
        piece, last = self.waiting[i], self.waiting.pop()
        if i < len(self.waiting):
            self.waiting[i] = last
            self.demand[i] = self.demand[len(self.waiting)]
        return piece

    def add(self, piece: Piece) -> None:
        while piece.length > self.limits.tokens or piece.loss > self.limits.loss_tokens:
            part, piece = piece.cut(piece.longest(self.limits.tokens, self.limits.loss_tokens))
            if part.length == self.limits.tokens:
                self.filled.append([part])
            else:
                self._wait(part)
        if piece.length:
            self._wait(piece)
        if len(self.waiting) >= WAITING:
            self.pack(WAITING // 2)

    def pack(self, down_to: int = 0) -> None:
        while len(self.waiting) > down_to:
            self._fill()

    def _fill(self) -> None:
        pieces: list[Piece] = []
        room = self.full.copy()
        while self.waiting and room[0] and room[1] and room[2]:
            asked = self.demand[: len(self.waiting)]
            fits = (asked <= room).all(axis=1)
            if fits.any():
                worth = (asked / self.full) @ (room / self.full)
                piece = self._take(int(np.argmax(np.where(fits, worth, -1.0))))
            else:
                whole = self._take(int(np.argmax(asked[:, 0])))
                length = whole.longest(int(room[0]), int(room[2]))
                piece, rest = whole.cut(length)
                self._wait(rest)
            pieces.append(piece)
            room -= (piece.length, 1, piece.loss)
        length = self.limits.tokens - int(room[0])
        if room[0]:
            spare = length - (1 << (length.bit_length() - 1))
            while spare:
                last = pieces.pop()
                if last.length > spare:
                    last, rest = last.cut(last.length - spare)
                    pieces.append(last)
                else:
                    rest = last
                spare -= rest.length
                self._wait(rest)
        self.filled.append(pieces)


COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"
_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def packed(
    examples: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    key: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row for each piece of an example: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    An example's ids are those of the prompt, if a prompt column is named, then those of the text, then END_ID; all but
    the prompt's bear loss. A null text or prompt is empty, so a null text alone gives the one id END_ID. Keys may be
    null or repeated; each row is packed. An empty table gives an empty result. Sequences are numbered within the
    input partitions, so equal partitions give equal results. `tokenizer` is the path of the tokenizer's file. A Python
    worker remembers the ids of so many words; that changes its time and memory, never the result.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = word_tokenizer(tokenizer, remembered), Packer(limits)
        number = TaskContext.get().partitionId() * _NUMBERS

        def finished() -> pa.RecordBatch:
            nonlocal number
            rows = []
            for pieces in packer.filled:
                offset = 0
                for p in pieces:
                    check = zlib.crc32(p.ids[p.start : p.stop].astype("<u4").tobytes())
                    rows.append((p.key, p.start, p.length, check, len(p.ids), number, offset, p.loss))
                    offset += p.length
                number += 1
            packer.filled.clear()
            columns = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _NAMES)

        end = np.array([END_ID], dtype=words.width)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i, found in enumerate(keys):
                before = words.ids((batch.column(2)[i].as_py() or "").encode()) if prompt else end[:0]
                after = words.ids((batch.column(1)[i].as_py() or "").encode())
                ids = np.concatenate([before, after, end])
                packer.add(Piece(found, ids, len(before), 0, len(ids)))
                if len(packer.filled) >= 1000:
                    yield finished()
        packer.pack()
        yield finished()

    columns = [F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")]
    if prompt:
        columns.append(F.col(prompt).cast("string").alias("prompt"))
    return examples.select(*columns).mapInArrow(rows_of, COLUMNS)
