"""Groups of spelling variants: words of the corpus, those one edit apart, and each word's prevailing form.

The vocabulary acceptor, the one-edit transducer and the acceptor again are composed in parts. A part holds the words
that agree in what they read before a block of places and after it, so all its pairs leave from one state of the whole
composition and return to one; the part's machine starts there and reads the block alone. Every pair has one first place
where its words differ, hence one block and one part.

At first there are two blocks, the halves of a word. A part with too many words has its block halved again, until its
machine is small enough or the block is one place, where the alphabet bounds the part.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.acceptors import Acceptor, one_edit_pairs
from stallbook.plans.staging import stage

SHORTEST, LEAST = 5, 3
# Words in a part beyond which its block is halved.
PART_WORDS = 2000
# Distinct words a task counts before it hands them on.
_COUNTED = 200_000
_RUN = regex.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)


def counted(documents: DataFrame, every: int = 97, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): how often each word occurs in all texts, words below LEAST occurrences left out.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, of which A-Z are lower-cased, of SHORTEST letters at least.
    If `every` divides the CRC-32 of "<key>:<word>", the word is counted without its letter number CRC modulo its length.
    A null text has no words. A null key is written as nothing. Repeated rows count each time.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not value.is_valid:
                    continue
                # lower() of bytes is for A-Z only
                words = Counter(_RUN.findall(value.as_buffer().to_pybytes().lower().decode("utf-8", "replace")))
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in words.items():
                    drawn = zlib.crc32(word.encode(), start)
                    if drawn % every == 0:
                        at = drawn % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < SHORTEST:
                            continue
                    total[word] += n
                if len(total) > _COUNTED:
                    yield handed_on()
        yield handed_on()

    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = source.mapInArrow(rows_of, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)


_KEY = ["m", "low", "high", "before", "behind"]


def _blocked(words: DataFrame, low: Column, high: Column) -> DataFrame:
    """With a part's key: m, the length of the shorter word of a pair, the block [low, high), and what is around it."""
    words = words.withColumns({"low": low, "high": high})
    return words.withColumns(
        {
            "before": F.expr("substring(word, 1, low)"),
            "behind": F.expr("right(word, m - high)"),
        }
    )


def parted(vocabulary: DataFrame, limit: int | None = None) -> DataFrame:
    """The words (word, n) with each part they belong to; no part is larger than `limit` but those of one place."""
    limit = limit or PART_WORDS
    size = F.char_length("word")
    both = F.array(size, size - 1)  # with words as long or longer by one, and with words shorter by one
    words = vocabulary.select("word", "n", F.explode(both).alias("m")).where(F.col("m") >= 1)
    middle = F.floor(F.col("m") / 2).cast("int")
    rows = _blocked(words, F.lit(0), middle).unionByName(_blocked(words, middle, F.col("m")))
    done: DataFrame | None = None
    while True:
        rows = stage(rows, "parts")
        sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("members"))
        large = stage(sizes.where((F.col("members") > limit) & (F.col("high") - F.col("low") > 1)).drop("members"), "large-parts")
        if not large.limit(1).count():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, _KEY, "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        halved = rows.join(large, _KEY, "left_semi").select("word", "n", "m", "low", "high")
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        rows = _blocked(halved, F.col("low"), middle).unionByName(_blocked(halved, middle, F.col("high")))


def pairs_of(members: list[tuple[str, int]], m: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Which words (word, n) of one part are one edit apart inside its block, as pairs of places in the list."""
    inner = {word[low : len(word) - (m - high)]: i for i, (word, _) in enumerate(members)}
    for u, w in one_edit_pairs(Acceptor(sorted(inner)), at_end=high == m):
        if len(u) == high - low:  # two words of the longer length meet in the parts of their own length
            yield inner[u], inner[w]


def _near_in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of parts in order, for each word with near ones: their number, and the one with the largest n."""
    now: tuple | None = None
    members: list[tuple[str, int]] = []
    found: list[tuple[str, int, int, str]] = []

    def finish() -> None:
        if len(members) < 2:
            return
        near: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for a, b in pairs_of(members, now[0], now[1], now[2]):
            near[a].append((-members[b][1], members[b][0]))
            near[b].append((-members[a][1], members[a][0]))
        for i, others in near.items():
            n, form = min(others)
            found.append((members[i][0], len(others), -n, form))

    def handed_on() -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[], [], [], []]
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _NEAR.types, strict=True)], schema=_NEAR)

    for batch in batches:
        word, n, *key = [batch.column(c).to_pylist() for c in ["word", "n", *_KEY]]
        for i, part in enumerate(zip(*key, strict=True)):
            if part != now:
                finish()
                now, members = part, []
            members.append((word[i], n[i]))
        yield handed_on()
    finish()
    yield handed_on()


_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def variants(vocabulary: DataFrame, times: int = 2) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of each word of a vocabulary (word, n); words are distinct.

    Near words differ by one letter that is inserted, deleted or replaced. The form is the near word of the largest n,
    ties the smallest word, if that n is `times` the word's or more. The root is reached by forms; a word without form
    is its own root. An empty vocabulary gives an empty result; null words are left out.
    """
    vocabulary = stage(vocabulary.where("word is not null").select("word", "n"), "vocabulary")
    rows = parted(vocabulary)
    # a word alone in its part meets nobody
    sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("members")).where("members > 1").drop("members")
    met = rows.join(sizes, _KEY, "left_semi").select("word", "n", *_KEY)
    ordered = met.repartition(*_KEY).sortWithinPartitions(*_KEY)
    near = ordered.mapInArrow(_near_in_parts, "word string, n_near long, best_n long, best string")
    near = near.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("best")
    )
    better = -F.col("best.less") >= times * F.col("n")
    words = vocabulary.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best.best")).alias("form"),
        F.when(better, -F.col("best.less")).alias("form_n"),
    )
    words = stage(words, "forms")
    return words.join(roots(words), "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(words: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form.

    Each round follows twice as many forms as the last; n at least doubles from form to form, so few rounds are needed.
    """
    steps = stage(words.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        steps = moved.select("word", "root")
        if not moved.where("next is not null").limit(1).count():
            return steps
