"""Secrets in whole texts by a trigram index over the rules, then verification of the candidates.

Each rule's pattern gives sets of trigrams of which a matching text must hold one set in full. Postings of these
trigrams (and of no others) are built from the lower-cased texts and intersected per rule; only texts that survive are
searched with the rule's pattern. A rule without mandatory trigrams searches all texts. All of it is built-in
expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.llm.trigrams import needed
from stallbook.plans.staging import stage


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and how long a group of the match must be (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the three base kinds in the order of results
BASE = (
    Rule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
        r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    # runs are maximal, so asking for the length in the pattern finds the same ones
    Rule("hex", r"[0-9a-f]{32,}", least=32),
)
RULES = (
    *BASE,
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)


def _queries(rules: tuple[Rule, ...]) -> dict[str, list[frozenset[str]]]:
    return {r.kind: needed(r.pattern) for r in rules}


def postings(documents: DataFrame, grams: list[str], text: str, identity: list[str]) -> DataFrame:
    """(gram, identity) for the listed trigrams, each once for a text."""
    low = documents.select(*identity, F.lower(F.col(text)).alias("__low"))
    marks = F.array(*(F.when(F.contains("__low", F.lit(g)), F.lit(g)) for g in grams))
    return low.select(*identity, F.explode(F.array_compact(marks)).alias("gram"))


def candidates(documents: DataFrame, rules: tuple[Rule, ...], text: str, identity: list[str]) -> DataFrame:
    """(identity, rules): the rules with trigrams whose query the text satisfies; texts without any are left out."""
    clauses = [
        (kind, n, gram, len(grams))
        for kind, sets in _queries(rules).items()
        for n, grams in enumerate(sets)
        for gram in sorted(grams)
    ]
    spark = documents.sparkSession
    query = spark.createDataFrame(clauses, "rule string, clause int, gram string, grams int")
    found = postings(documents, sorted({c[2] for c in clauses}), text, identity).join(F.broadcast(query), "gram")
    # a text's postings leave one task together, so they are counted before the shuffle
    full = found.groupBy(*identity, "rule", "clause").agg(F.count_distinct("gram").alias("n"), F.max("grams").alias("grams"))
    return full.where("n = grams").groupBy(*identity).agg(F.collect_set("rule").alias("rules"))


# Matches of a text that are put together in one array; such arrays are then joined, as an append copies its array.
_TOGETHER = 256
_SPAN = "array<struct<start: int, rank: int, end: int, kind: string>>"


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Start and end in code points of the accepted matches, from the pieces between all matches."""
    pattern = F.lit(rule.pattern)
    once = F.struct(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"),
        F.split(text, rule.pattern, -1).alias("between"),
    )

    def located(parts: Column) -> Column:
        zipped = F.arrays_zip(parts["found"], parts["value"], F.slice(parts["between"], 1, F.size(parts["found"])))
        return F.element_at(F.transform(F.array(zipped), placed), 1)

    def placed(items: Column) -> Column:
        def step(state: Column, item: Column) -> Column:
            start = state["at"] + F.length(item["2"])
            end = start + F.length(item["found"])
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
            good = F.length(item["value"]) >= rule.least
            return F.struct(end.alias("at"), F.when(good, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

        def begun(at: Column) -> Column:
            return F.struct(at.alias("at"), F.array().cast(_SPAN).alias("spans"))

        def later(states: Column, k: Column) -> Column:
            some = F.slice(items, k * _TOGETHER + 1, _TOGETHER)
            return F.array_append(states, F.aggregate(some, begun(F.element_at(states, -1)["at"]), step))

        numbers = F.sequence(F.lit(0), F.floor(F.size(items) / _TOGETHER).cast("int"))
        states = F.aggregate(numbers, F.array(begun(F.lit(0))), later)
        return F.flatten(F.transform(states, lambda state: state["spans"]))

    return F.element_at(F.transform(F.array(once), located), 1)


def scanned(documents: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, spans of each row: an array of (start, rank, end, kind) by start, then by the order of the rules.

    Positions count code points, the end is exclusive; matches of a rule are leftmost and do not overlap. A null text is
    empty. Rows are told apart by key and text, so null or repeated keys do no harm; an empty table gives an empty result.
    """
    rows = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    identity = ["doc_id", "text_hash"]
    listed = stage(candidates(rows, rules, "text", identity), "candidates")
    listed = listed.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "rules")
    met = rows.join(listed, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_hash") == F.col("__hash")), "left")
    indexed = {kind for kind, sets in _queries(rules).items() if sets}
    empty = F.array().cast(_SPAN)
    parts = []
    for rank, rule in enumerate(rules):
        asked = F.array_contains("rules", rule.kind) if rule.kind in indexed else F.col("text").rlike(rule.pattern)
        parts.append(F.when(F.coalesce(asked, F.lit(False)), _spans(F.col("text"), rule, rank)).otherwise(empty))
    return met.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digested(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans from the rows of `scanned`."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(n).alias(f"n_{r.kind}") for n, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_text(base), 256).alias("base_sha256"), _text(F.col("spans")).alias("spans"))
