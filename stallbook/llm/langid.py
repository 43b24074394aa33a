"""Language of whole texts by a bidirectional recurrent network over bytes.

The network reads a text in windows of several words and gives every byte a distribution over the languages; a
document's distribution is the mean over all its bytes but blanks. Its state runs on from word to word. A window begins
and ends at blanks where there are some near, else between two characters, and reads some bytes before and after its
own, so that each byte is labelled with both sides of it known. No byte of a text is left out.

The network is trained on the driver from a bounded sample: at most SAMPLE_PIECES runs of words of at most about
SAMPLE_DOCS documents of each language, chosen by hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.gru import ByteGru, padded, train

SAMPLE_DOCS, SAMPLE_PIECES, PIECE_WORDS = 120, 12, 8
# A small sample is read more often, so that the network is trained in about STEPS steps at least.
WIDTH, ROUNDS, STEPS, BATCH, SEED = 8, 4, 240, 64, 20240611
# Bytes of a window's own, bytes around them that are read too, and how far back a blank is looked for to begin at.
WINDOW, AROUND, BACK = 96, 16, 16
# Windows that are read together.
_TOGETHER = 1024
UNKNOWN = "und"
_HASH_RANGE = 1 << 30
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_INNER = (np.arange(256) & 0xC0) == 0x80
_AS_SPACE = bytes.maketrans(b"\t\n\v\f\r", b"     ")


def held_out(key: str = "doc_id") -> Column:
    return (F.crc32(F.col(key).cast("string")) % 3) == 1


def _sample(documents: DataFrame, key: str, text: str, lang: str) -> list[tuple[str, list[str]]]:
    """(language, runs of words) of the sampled documents; the counts per language set the share of each."""
    usable = documents.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~F.coalesce(held_out(key), F.lit(False)))
    known = {r["lang"]: r["n"] for r in usable.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not known:
        return []
    share = F.create_map(*(F.lit(x) for name, n in known.items() for x in (name, min(1.0, 1.5 * SAMPLE_DOCS / n))))
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(SEED)), F.lit(_HASH_RANGE)) / _HASH_RANGE
    drawn = usable.where(draw < F.element_at(share, F.col(lang))).select(
        F.col(lang).alias("lang"), draw.alias("draw"), F.xxhash64(F.col(text)).alias("h"), F.split(F.col(text), r"[\x20\x09-\x0D]+").alias("w")
    )
    piece = F.transform(
        F.sequence(F.lit(1), F.size("w"), F.lit(PIECE_WORDS)),
        lambda i: F.array_join(F.transform(F.slice("w", i, PIECE_WORDS), lambda w: F.substring(w, 1, WINDOW)), " "),
    )
    pieces = F.transform(F.array_distinct(piece), lambda p: F.struct(F.xxhash64(p).alias("h"), F.substring(p, 1, WINDOW).alias("p")))
    best = Window.partitionBy("lang").orderBy("draw", "h")
    rows = drawn.select("lang", "draw", "h", F.slice(F.array_sort(pieces), 1, SAMPLE_PIECES)["p"].alias("pieces"))
    rows = rows.withColumn("n", F.row_number().over(best)).where(F.col("n") <= SAMPLE_DOCS).collect()
    return [(r["lang"], r["pieces"]) for r in sorted(rows, key=lambda r: (r["lang"], r["n"]))]


def _framed(piece: bytes) -> bytes:
    return b" " + piece + b" "


def fitted(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], ByteGru | None]:
    """The languages in order and the trained network; none without a labelled document that is not held out."""
    sample = _sample(documents, key, text, lang)
    langs = sorted({name for name, _ in sample})
    pieces = [(p.encode(), langs.index(name)) for name, found in sample for p in found if p.strip()]
    if not pieces:
        return langs, None
    sequences, labels = _sequences(pieces)
    rounds = max(ROUNDS, -(-STEPS * BATCH // len(sequences)))
    return langs, train(sequences, labels, len(langs), WIDTH, min(rounds, STEPS), BATCH, SEED)


def _sequences(pieces: list[tuple[bytes, int]]) -> tuple[list[bytes], list[np.ndarray]]:
    """Sequences to learn from and the labels of their bytes.

    Half of the pieces stand alone, the others in random pairs: from these the network learns that the language may change
    within a text, so that its state does not cling to what it has read before.
    """
    order = np.random.default_rng(SEED).permutation(len(pieces))
    half = len(order) // 4 * 2
    groups = [order[i : i + 2] for i in range(0, half, 2)] + [order[i : i + 1] for i in range(half, len(order))]
    sequences = [_framed(b" ".join(pieces[i][0] for i in group)) for group in groups]
    labels = [np.concatenate([np.full(len(pieces[i][0]) + 1, pieces[i][1]) for i in group]) for group in groups]
    return sequences, [np.append(x, x[-1]) for x in labels]


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts with a blank between any two, the borders of the windows' own bytes, and the text of each window."""
    data = np.frombuffer(_framed(b" ".join(texts)).translate(_AS_SPACE), np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    first = 1 + np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
    count = np.maximum(-(-lengths // WINDOW), 1)
    text = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    low = first[text] + place * WINDOW
    later = place > 0
    low[later] = _begun(data, low[later])
    high = np.append(low[1:], 0)
    last = np.append(text[1:] != text[:-1], True)
    high[last] = (first + lengths)[text[last]]
    return data, np.stack([low, high]), text


def _begun(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each place moved back to just after a blank, or, without one among the last BACK bytes, to the start of its character."""
    before = data[at[:, None] - 1 - np.arange(BACK)]
    blank = _BLANK[before]
    whole = at - np.argmin(_INNER[data[at[:, None] - np.arange(4)]], axis=1)
    return np.where(blank.any(axis=1), at - blank.argmax(axis=1), whole)


class TextScores:
    """Distributions of the bytes of texts, by windows."""

    def __init__(self, net: ByteGru, labels: int):
        self.net, self.labels = net, labels

    def parts(self, texts: list[bytes]):
        """(text of each window, first of its places, distributions, which are its own and no blank), some windows at a time.

        Distributions are (steps, windows, labels); places count in the texts with a blank between any two.
        """
        data, (low, high), text = windows(texts)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        first = 1 + np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)
        # the blanks at both ends of a text are read with it
        begin = np.maximum(low - AROUND, first[text] - 1)
        end = np.minimum(high + AROUND, (first + lengths)[text] + 1)
        order = np.argsort(end - begin, kind="stable")
        for at in range(0, len(order), _TOGETHER):
            part = order[at : at + _TOGETHER]
            place = begin[part] + np.arange(int((end - begin)[part[-1]]))[:, None]
            live = place < end[part]
            read = np.where(live, data[np.minimum(place, len(data) - 1)], 0)
            score = np.moveaxis(self.net.distributions(read, live), 0, 2)
            own = (place >= low[part]) & (place < high[part]) & ~_BLANK[read]
            yield text[part], begin[part], score, own

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """The mean distribution of each text; zeros for a text without words."""
        total = np.zeros((len(texts), self.labels + 1))
        for text, _, score, own in self.parts(texts):
            sums = np.einsum("tbl,tb->bl", score, own.astype(score.dtype)).astype(np.float64)
            np.add.at(total, text, np.column_stack([sums, own.sum(axis=0)]))
        return total[:, :-1] / np.maximum(total[:, -1:], 1)

    def positions(self, text: bytes) -> np.ndarray:
        """The most probable label of each byte; -1 for blanks."""
        result = np.full(len(text) + 2, -1)
        for _, begin, score, own in self.parts([text]):
            step, window = np.nonzero(own)
            result[begin[window] + step] = score[step, window].argmax(axis=1)
        return result[1:-1]


def labelled(documents: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row.

    A null text, or one without a letter, is `und` with score 0, as is every text if there was nothing to learn from.
    A row without key is not held out (its remainder is unknown) and is not learned from either. Equal scores go to
    the first language in order. Repeated rows get equal answers; an empty table gives an empty result.
    """
    with_key = documents.where(F.col(key).isNotNull())
    langs, net = fitted(with_key, key, text, lang)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = TextScores(net, len(langs)) if net else None
        for batch in batches:
            column = batch.column(2).cast(pa.large_binary())
            low = 0
            while low < len(batch):
                texts, size = [], 0
                while low + len(texts) < len(batch) and (not texts or size < 1 << 20):
                    texts.append(column[low + len(texts)].as_py() or b"")
                    size += len(texts[-1])
                part = batch.slice(low, len(texts))
                low += len(texts)
                usable = part.column(3).to_numpy(zero_copy_only=False).astype(bool)
                names, best = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
                if scores is not None:
                    pooled = scores.pooled([t if u else b"" for t, u in zip(texts, usable, strict=True)])
                    first = pooled.argmax(axis=1)
                    names[usable] = np.array(langs, object)[first[usable]]
                    # how windows lie together may change the last digits of a float
                    best[usable] = np.clip(np.round(pooled.max(axis=1)[usable], 5), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(best)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    source = documents.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(held_out(key), F.lit(False)).alias("held_out"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("usable"),
    )
    return source.mapInArrow(rows_of, "doc_id long, held_out boolean, lang_pred string, score double")
