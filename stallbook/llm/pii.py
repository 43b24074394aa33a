"""Personal data in whole texts: fixed patterns, and a skip-chain conditional random field that makes labels consistent.

The patterns find whatever they find. The field then labels every token with a digit or an @: neighbours in the text
are chained, and each occurrence of a token (its letters and digits) is linked to the next one of the document, however
far. Tokens inside pattern matches keep their label, and each other occurrence is linked to them at once, however many
stand between: all matches with a token are one node of known label, so the links are as many as the tokens. Tokens that
write the digits of a matched card or phone number in another way, such as a phone number without its country code, are
linked to it too. Other tokens are outside the field: they never bear a label.

The weights are fitted on the driver by pseudo-likelihood on a bounded sample (at most SAMPLE_DOCS documents, at most
SAMPLE_TOKENS tokens of each), with the pattern matches as labels.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.llm.crf import CHAIN, SKIP, Field, fit, marginals

SAMPLE_DOCS, SAMPLE_TOKENS, SEED = 8000, 32, 40
# Weights of equal labels on chain and skip links before any evidence, and the shortest token with skip links.
PRIOR, CORE = (1.0, 3.0), 4
# The weight of a link to matches that agree in so many letters and digits at least, which is hardly chance. The sample
# cannot tell it: its labels are the matches only.
SAME, WHOLE = 6.0, 7
# How sure the field must be to add a span.
SURE = 0.6
_HASH_RANGE = 1 << 30

# fixed values: kinds in the order of results, and their patterns
KINDS = ("email", "ip", "card", "phone")
# A digit run is never entered in its middle and never given back: the matches stay the same, the time is linear.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Kinds that are numbers whichever way their digits are grouped, the forms of their groups, and what may stand between.
_NUMBERS, _TEN, _LONGEST = ("card", "phone"), frozenset("0123456789"), 19
_WRITTEN = re.compile(r"[0-9+()./-]*[0-9][0-9+()./-]*")
_BETWEEN = frozenset((" ", "  ", "-", " - ", "", " (", ") ", ".", ". ", "\n", "\t"))

_HINT = re.compile(r"[0-9@]")
_BLANKS = " \t\n\x0b\x0c\r"
_TRIM = ".,;:!?'\"<>[]{}|#$%&*"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, looked for from each @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def patterns(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches, by kind and start."""
    found = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (g.lstrip("0") or "0" for g in m.groups())):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((3, *m.span()))
    return found


class Tokens:
    """The tokens of a text that the field labels: spans, features, labels from the patterns (-1: none), and links."""

    def __init__(self, text: str, found: list[tuple[int, int, int]]):
        self.spans: list[tuple[int, int]] = []
        covered = sorted((a, b, k) for k, a, b in found)
        end, n = 0, len(text)
        for hint in _HINT.finditer(text):
            if hint.start() < end:
                continue
            start, end = hint.start(), hint.end()
            floor = self.spans[-1][1] if self.spans else 0
            while start > floor and text[start - 1] not in _BLANKS:
                start -= 1
            while end < n and text[end] not in _BLANKS:
                end += 1
            low, high = start, end
            while low < high and text[low] in _TRIM:
                low += 1
            while high > low and text[high - 1] in _TRIM:
                high -= 1
            self.spans.append((low, high))
        self.words = [text[a:b] for a, b in self.spans]
        self.labels = np.full(len(self.spans), -1)
        self.inside = np.zeros(len(self.spans), dtype=bool)
        at = 0
        for i, (a, b) in enumerate(self.spans):
            while at < len(covered) and covered[at][1] <= a:
                at += 1
            for low, high, kind in covered[at : at + 4]:
                if low < b and high > a:
                    self.inside[i] = True
                    if self.labels[i] < 0:
                        self.labels[i] = kind
        self.gaps = [text[p[1] : q[0]] for p, q in zip(self.spans, self.spans[1:])]
        cores = ["".join(c for c in word.lower() if c.isalnum()) for word in self.words]
        chain = [(i, i + 1) for i, gap in enumerate(self.gaps) if len(gap) <= 3]
        last: dict[str, int] = {}
        skip = []
        for i, core in enumerate(cores):
            if len(core) >= CORE:
                if core in last:
                    skip.append((last[core], i))
                last[core] = i
        self.links = np.array(chain + skip, dtype=np.int64).reshape(-1, 2)
        self.kinds = np.array([CHAIN] * len(chain) + [SKIP] * len(skip), dtype=np.int64)
        self._tell(text, found, cores)

    def _tell(self, text: str, found: list[tuple[int, int, int]], cores: list[str]) -> None:
        """told: of tokens outside the matches, counts by kind of the matches that write the same; whole: a long piece."""
        n, kinds = len(self.words), len(KINDS)
        self.told, self.whole = np.zeros((n, kinds)), np.zeros(n, dtype=bool)
        by_core: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(kinds))
        for i in np.flatnonzero(self.inside):
            if len(cores[i]) >= CORE:
                by_core[cores[i]][self.labels[i]] += 1
        numbers: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(kinds))
        for kind, a, b in found:
            digits = "".join(c for c in text[a:b] if c in _TEN)
            if KINDS[kind] in _NUMBERS:
                # a phone number stands without the codes before it, too
                for drop in range(len(digits) - WHOLE + 1 if KINDS[kind] == "phone" else 1):
                    numbers[digits[drop:]][kind] += 1
        for i in np.flatnonzero(~self.inside) if by_core else ():
            if cores[i] in by_core:
                self.told[i], self.whole[i] = by_core[cores[i]], len(cores[i]) >= WHOLE
        plain = [not self.inside[i] and _WRITTEN.fullmatch(w) is not None for i, w in enumerate(self.words)] if numbers else []
        for i in np.flatnonzero(plain):
            run, last = "", i
            while last < n and plain[last] and (last == i or self.gaps[last - 1] in _BETWEEN):
                run += "".join(c for c in self.words[last] if c in _TEN)
                if len(run) > _LONGEST:
                    break
                if run in numbers:
                    self.told[i : last + 1], self.whole[i : last + 1] = numbers[run], True
                last += 1

    def features(self) -> np.ndarray:
        """Forms of the tokens: marks, digits, dots, and whether a neighbour stands close."""
        x = np.zeros((len(self.words), FEATURES))
        for i, w in enumerate(self.words):
            digits, dots = sum(c.isdigit() for c in w), w.count(".")
            x[i, 0] = 1
            x[i, 1 + int(np.searchsorted(_DIGITS, digits, side="right"))] = 1
            x[i, 11 + min(dots, 4)] = 1
            x[i, 16:24] = (
                "@" in w, "@" in w and "." in w.partition("@")[2], w.startswith("+"), "-" in w,
                "(" in w or ")" in w, any(c.isalpha() for c in w), any(c in "=:/\"'_" for c in w), len(w) > 20,
            )
        close = [len(g) <= 3 for g in self.gaps]
        x[1:, 24], x[:-1, 25] = close, close
        return x

    def neighbours(self) -> np.ndarray:
        """(n, 2, labels): neighbours by kind of link and label, where 0 is no personal data."""
        counts = np.zeros((len(self.words), 2, len(KINDS) + 1))
        for (a, b), kind in zip(self.links, self.kinds, strict=True):
            counts[a, kind, self.labels[b] + 1] += 1
            counts[b, kind, self.labels[a] + 1] += 1
        return counts


_DIGITS = np.array([1, 2, 3, 4, 5, 8, 12, 16, 20])
FEATURES = 26


def _added(tokens: Tokens, field: Field) -> list[tuple[int, int, int]]:
    """Spans that the field adds: touching tokens of one label are one span."""
    open_ones = ~tokens.inside
    if not open_ones.any():
        return []
    unary = tokens.features() @ field.nodes
    fixed = np.flatnonzero(tokens.inside)
    unary[fixed, tokens.labels[fixed] + 1] += 50.0
    # what a neighbour of known label says: the message of a node for all matches that write the same
    told = np.flatnonzero(tokens.told.any(axis=1))
    weight = np.where(tokens.whole[told], max(SAME, field.edges[SKIP]), field.edges[SKIP])[:, None]
    unary[told, 1:] += np.log1p(np.expm1(weight) * tokens.told[told] / tokens.told[told].sum(axis=1, keepdims=True))
    p = marginals(unary, tokens.links, tokens.kinds, field.edges)
    best = p.argmax(axis=1)
    found: list[tuple[int, int, int]] = []
    before = -2
    for i in np.flatnonzero(open_ones & (best > 0) & (p.max(axis=1) >= SURE)):
        kind, (a, b) = int(best[i]) - 1, tokens.spans[i]
        if found and before == i - 1 and found[-1][0] == kind and tokens.gaps[i - 1] in ("", " ", "-"):
            found[-1] = (kind, found[-1][1], b)
        else:
            found.append((kind, a, b))
        before = i
    return found


def spans_of(text: str, field: Field | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Pattern spans and added spans of a text, as (kind, start, end)."""
    if not _HINT.search(text):
        return [], []
    found = patterns(text)
    if field is None:
        return found, []
    return found, _added(Tokens(text, found), field)


def sample(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) of documents with a digit or @, drawn by a hash of both; rows that agree in both count once.

    Each of them is drawn for itself, so neither a hot key nor a hot text is drawn as a whole. The share lies four
    standard deviations below SAMPLE_DOCS of all rows, which no draw exceeds but once in 30,000.
    """
    share = (SAMPLE_DOCS - 4 * SAMPLE_DOCS**0.5) / max(documents.count(), 1)
    draw = F.pmod(F.xxhash64("key", "text", F.lit(SEED)), F.lit(_HASH_RANGE)) / _HASH_RANGE
    rows = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.where((draw < min(1.0, share)) & F.col("text").rlike("[0-9@]")).distinct()


def fitted(documents: DataFrame, key: str, text: str) -> Field | None:
    """Weights from a bounded sample; None if the sample has no personal data."""
    drawn = sample(documents, key, text)

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for value in batch.column(0).to_pylist():
                found = patterns(value)
                tokens = Tokens(value, found)
                x, near = tokens.features(), tokens.neighbours()
                # tokens with a label first: most documents have none; what is written as in a match is no counterexample
                order = np.argsort(tokens.labels < 0, kind="stable")
                order = order[~tokens.told.any(axis=1)[order]][:SAMPLE_TOKENS]
                rows += [(x[i].tolist(), near[i].ravel().tolist(), int(tokens.labels[i]) + 1) for i in order]
            if rows:
                form, near, label = zip(*rows, strict=True)
                kind = pa.list_(pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(form, kind), pa.array(near, kind), pa.array(label, pa.int32())], ["form", "near", "label"]
                )

    rows = drawn.select("text").mapInArrow(tokens_of, "form array<double>, near array<double>, label int").collect()
    if not any(r["label"] for r in rows):
        return None
    rows = sorted(rows, key=lambda r: (r["label"], r["form"], r["near"]))
    near = np.array([r["near"] for r in rows]).reshape(len(rows), 2, len(KINDS) + 1)
    return fit(np.array([r["form"] for r in rows]), near, np.array([r["label"] for r in rows]), PRIOR)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def found_in(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of each row.

    Counts and base_sha256 are of the pattern matches; spans lists all, added ones too, as kind:start:end by kind and
    start, in code points, the end exclusive. A null text is empty. Keys may be null or repeated. An empty table gives
    an empty result.
    """
    field = fitted(documents, key, text)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, more = [], [], [], []
            for value in batch.column(1):
                base, added = spans_of(value.as_py() or "", field)
                counts.append([sum(k == n for k, _, _ in base) for n in range(len(KINDS))])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(base + added))
                more.append(len(added))
            columns = [pa.array([c[n] for c in counts], pa.int64()) for n in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(more, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    source = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(rows_of, schema)
