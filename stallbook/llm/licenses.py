"""Licence texts inside documents: Dice coefficient of word bigrams between a passage and licence templates.

Text and templates are normalised to lower-case words of letters and digits. A passage begins and ends with a bigram
of the template. Dice = 2 common / (passage + template) can reach the threshold t only if the passage has between
t / (2 - t) and (2 - t) / t times the template's bigrams, and at least as many of the template's bigrams as the lower
bound says. These bounds leave a few starting points; only those are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.license_texts import TEMPLATES
from stallbook.llm.words import ALNUM, LOWER, blocks, find_words, runs

THRESHOLD = 0.8


class Templates:
    """The bigrams of all templates, and which template has which."""

    def __init__(self, texts: dict[str, str], threshold: float):
        self.names = list(texts)
        block = next(blocks(pa.array(list(texts.values())), 1 << 30))
        found = find_words(block, ALNUM, LOWER)
        sets = []
        for low, high in zip(found.row_first[:-1], found.row_first[1:], strict=True):
            sets.append(np.unique(runs(found.hashes[low:high], 2)))
        self.bigrams = np.unique(np.concatenate(sets))
        self.member = np.zeros((len(sets), len(self.bigrams)), dtype=bool)
        for i, s in enumerate(sets):
            self.member[i, np.searchsorted(self.bigrams, s)] = True
        self.sizes = self.member.sum(axis=1)
        self.threshold = threshold
        self.least = np.ceil(self.sizes * threshold / (2 - threshold) - 1e-9).astype(int)
        self.most = np.floor(self.sizes * (2 - threshold) / threshold + 1e-9).astype(int)

    def passages(self, template: int, at: np.ndarray, ids: np.ndarray, every: np.ndarray, stop: np.ndarray):
        """(first bigram, last bigram, dice) of the passages of one template, from left to right, not overlapping.

        at: positions of the template's bigrams, ids: which they are; every: all bigrams; stop: for each position the
        end of its row. The first starting point that reaches the threshold opens a passage; of all passages that begin
        within it the best is taken, of equal ones that which begins first, and of these the longest.
        """
        last = np.minimum(np.searchsorted(at, at + self.most[template]), np.searchsorted(at, stop))
        hits = np.minimum(last - np.arange(len(at)), self.sizes[template])
        # more than this no passage from a starting point can reach
        bound = 2 * hits / (hits + self.sizes[template])
        done = -1
        for i in np.flatnonzero(hits >= self.least[template]):
            if at[i] <= done:
                continue
            dice, end = self._best_from(template, slice(i, last[i]), at, ids, every)
            if dice < self.threshold - 1e-12:
                continue
            first, within = i, np.searchsorted(at, end, "right")
            for k in range(i + 1, within):
                if bound[k] > dice + 1e-12:
                    other, its_end = self._best_from(template, slice(k, last[k]), at, ids, every)
                    if other > dice + 1e-12:
                        first, dice, end = k, other, its_end
            done = end
            yield int(at[first]), end, dice

    def _best_from(self, template: int, reach: slice, at: np.ndarray, ids: np.ndarray, every: np.ndarray) -> tuple[float, int]:
        """The highest Dice coefficient of the passages that begin at the first hit of the reach, and where the longest ends."""
        window = every[at[reach.start] : at[reach.stop - 1] + 1]
        ends = at[reach] - at[reach.start]
        dice = 2 * _distinct(ids[reach]) / (_distinct(window)[ends] + self.sizes[template])
        best = len(dice) - 1 - int(np.argmax(dice[::-1]))
        return float(dice[best]), int(at[reach.start] + ends[best])


def _distinct(values: np.ndarray) -> np.ndarray:
    """How many distinct values there are up to each place."""
    fresh = np.zeros(len(values), dtype=np.int64)
    fresh[np.unique(values, return_index=True)[1]] = 1
    return np.cumsum(fresh)


def scanned(
    documents: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, license, dice, start, end of each passage that matches a template, in code points, the end exclusive.

    A passage may match several templates; each gives a row. Null, blank and one-word texts give none. Keys may be
    null or repeated; each row is searched. An empty table gives an empty result.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        for batch in batches:
            rows = []
            for block in blocks(batch.column(1)):
                found = find_words(block, ALNUM, LOWER)
                every = runs(found.hashes, 2)
                if not len(every):
                    continue
                row = found.row_of()
                slot = np.minimum(np.searchsorted(known.bigrams, every), len(known.bigrams) - 1)
                hits = np.flatnonzero((known.bigrams[slot] == every) & (row[:-1] == row[1:]))
                for t, name in enumerate(known.names):
                    at = hits[known.member[t, slot[hits]]]
                    if len(at) < known.least[t]:
                        continue
                    for low, high, dice in known.passages(t, at, slot[at], every, found.row_first[row[at] + 1] - 1):
                        begin = block.offsets[row[low]]
                        lead = block.data[begin : found.starts[low]]
                        body = block.data[found.starts[low] : found.ends[high + 1]]
                        start = int(((lead & 0xC0) != 0x80).sum())
                        end = start + int(((body & 0xC0) != 0x80).sum())
                        rows.append((batch.column(0)[block.first + int(row[low])].as_py(), name, dice, start, end))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "license", "dice", "start", "end"]
            )

    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(rows_of, "doc_id long, license string, dice double, start long, end long")
