"""Words of many texts at once: positions and 64-bit hashes over the bytes of an Arrow column.

A text is never decoded or split in Python. Blocks of rows are cut by bytes, so memory is bounded by the block size
or by the longest single text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 20
# Words up to this many bytes are hashed together, longer ones one by one.
_LONGEST = 128
_WEIGHTS = np.random.default_rng(20240229).integers(1, 2**63, _LONGEST, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_FACTOR_A, _FACTOR_B, _STEP = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)

# [^\x20\x09-\x0D]+: every byte but these six
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
# letters and digits; bytes of non-ASCII characters count as letters
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 32  # A-Z only


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection), so that any bits of the result may be used."""
    x = (x ^ (x >> U64(30))) * _FACTOR_A
    x = (x ^ (x >> U64(27))) * _FACTOR_B
    return x ^ (x >> U64(31))


@dataclass
class Block:
    """Some rows: their bytes end to end, and where each row begins (one more entry than rows)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of a block in order: byte ranges, hashes, and for each row the index of its first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    row_first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.row_first)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row_first) - 1), self.counts())


def blocks(column: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of about `limit` bytes; null is an empty text."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = chunk.cast(pa.large_string())
        if not len(chunk):
            continue
        if chunk.null_count:
            chunk = chunk.fill_null("")
        _, where, data = chunk.buffers()
        offsets = np.frombuffer(where, dtype=np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(chunk):
            stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            stop = min(max(stop, row + 1), len(chunk))
            low, high = offsets[row], offsets[stop]
            yield Block(row, whole[low:high], offsets[row : stop + 1] - low)
            row = stop


def find_words(block: Block, inside: np.ndarray = NOT_BLANK, fold: np.ndarray = SAME) -> Words:
    """Maximal runs of the bytes marked in `inside`, never across rows; hashes are over the folded bytes."""
    data, offsets = block.data, block.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, U64), np.zeros(len(offsets), np.int64))
    mask = inside[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = mask[firsts]
    stops = mask.copy()
    stops[:-1] &= ~mask[1:]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[lasts] = mask[lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    row_first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(starts, ends, np.zeros(0, U64), row_first)
    lengths = ends - starts
    where = np.flatnonzero(mask)
    place = np.arange(len(where)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    long = lengths > _LONGEST
    if long.any():
        place = np.minimum(place, _LONGEST - 1)
    part = (fold[data[where]].astype(U64) + U64(1)) * _WEIGHTS[place]
    sums = np.add.reduceat(part, np.cumsum(lengths) - lengths)
    hashes = mix(sums + lengths.astype(U64) * _STEP)
    for i in np.flatnonzero(long):
        digest = hashlib.blake2b(fold[data[starts[i] : ends[i]]].tobytes(), digest_size=8).digest()
        hashes[i] = np.frombuffer(digest, U64)[0]
    return Words(starts, ends, hashes, row_first)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for the k words from each position on; the last k-1 positions are left out."""
    n = len(hashes) - k + 1
    if n <= 0 or k < 1:
        return np.zeros(0, U64)
    value = np.full(n, k, dtype=U64) * _STEP
    for j in range(k):
        value = mix(value * U64(3) + hashes[j : j + n])
    return value


def shingles(found: Words, k: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word runs; with fewer words the whole row is one run."""
    every = runs(found.hashes, k)
    result = []
    for low, high in zip(found.row_first[:-1], found.row_first[1:], strict=True):
        if high - low >= k:
            result.append(np.unique(every[low : high - k + 1]))
        else:
            result.append(runs(found.hashes[low:high], int(high - low)))
    return result
