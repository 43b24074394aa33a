"""Quality rules whose limits follow the corpus: quantile sketches per language and source, then a joined filter.

A sketch is a histogram of integer values in log-linear buckets (64 to each power of two, so a quantile is off by
less than 1/64). Bucket counts of any two parts add up, whatever the order, so sketches are built before the
shuffle, merge exactly, and a group with few documents takes the merged sketch of its language or of the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallbook.llm.textstats import COUNTS, counted
from stallbook.plans.staging import stage

# Groups with fewer judged documents use the next coarser sketch.
MIN_GROUP = 200


@dataclass(frozen=True)
class Rule:
    """A limit lies `reach` times the distance of two quantiles, in hundredths, beyond the upper one, and below the lower.

    value: an integer of the counts; margin: how far beyond that is still accepted, for the width of a bucket and the
    scatter of short texts; applies: for which texts.
    """

    name: str
    value: str
    margin: int
    applies: str = "true"
    below: bool = False
    quantiles: tuple[int, int] = (25, 75)
    reach: int = 3


RULES = (
    # hundredths of a character; means over few words scatter too much to judge
    Rule("word_length", "word_chars * 100 div n_words", 50, "n_words >= 50", below=True),
    # symbols per thousand words: most texts have none, and up to a quarter may be junk
    Rule("symbols", "n_symbols * 1000 div n_words", 20, "n_words >= 10", quantiles=(50, 75)),
    # lines seen before, per thousand lines, and words of repeated windows, per thousand words: most texts have none, and
    # good ones may have many, so the limit follows the far end
    Rule("repeated_lines", "n_dup_lines * 1000 div n_lines", 20, "n_lines >= 5", quantiles=(90, 99), reach=1),
    Rule("repeated_words", "n_repeat_words * 1000 div n_words", 10, "n_words >= 10", quantiles=(90, 99), reach=1),
)

BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def _bucket(value: Column) -> Column:
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0)).cast("int")
    return (shift * 64 + F.call_function("shiftright", value, shift)).cast("long")


def _floor(bucket: Column) -> Column:
    """The smallest value of a bucket."""
    shift = F.greatest(F.floor(bucket / 64) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", bucket - shift * 64, shift)


def sketches(features: DataFrame, rules: tuple[Rule, ...], keys: tuple[str, str]) -> DataFrame:
    """(keys, rule, bucket, docs) over the texts that pass the base rules."""
    values = F.array(
        *(
            F.when(F.expr(r.applies), F.struct(F.lit(r.name).alias("rule"), F.expr(r.value).cast("long").alias("v")))
            for r in rules
        )
    )
    judged = features.where(f"not ({BASE_FAILED})").select(*keys, F.explode(F.filter(values, lambda x: x.isNotNull())).alias("x"))
    return judged.groupBy(*keys, F.col("x.rule").alias("rule"), _bucket(F.col("x.v")).alias("bucket")).agg(
        F.count("*").alias("docs")
    )


def _fences(sketch: DataFrame, keys: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(keys, rule, docs, low, high): each rule's two quantiles of a sketch, merged over whatever is not in keys."""
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("docs").alias("docs"))
    group = Window.partitionBy(*keys, "rule")
    ranked = merged.select(
        "*",
        F.sum("docs").over(group.orderBy("bucket")).alias("up_to"),
        F.sum("docs").over(group).alias("total"),
    )

    def quantile(side: int) -> Column:
        share = F.coalesce(*(F.when(F.col("rule") == r.name, F.lit(r.quantiles[side])) for r in rules))
        return _floor(F.min(F.when(F.col("up_to") * 100 >= F.col("total") * share, F.col("bucket"))))

    return ranked.groupBy(*keys, "rule").agg(F.max("total").alias("docs"), quantile(0).alias("low"), quantile(1).alias("high"))


def thresholds(features: DataFrame, rules: tuple[Rule, ...] = RULES, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source with columns <rule>_from and <rule>_to; null where nothing is known."""
    keys = (lang, source)
    sketch = stage(sketches(features, rules, keys), "sketches")
    fine, middle, whole = _fences(sketch, keys, rules), _fences(sketch, (lang,), rules), _fences(sketch, (), rules)
    groups = features.select(*keys).distinct().select(*keys, F.explode(F.array(*(F.lit(r.name) for r in rules))).alias("rule"))
    g, f, m, w = groups.alias("g"), fine.alias("f"), middle.alias("m"), whole.alias("w")
    same = F.col(f"g.{lang}").eqNullSafe(F.col(f"f.{lang}")) & F.col(f"g.{source}").eqNullSafe(F.col(f"f.{source}"))
    met = g.join(f, same & (F.col("g.rule") == F.col("f.rule")), "left")
    met = met.join(m, F.col(f"g.{lang}").eqNullSafe(F.col(f"m.{lang}")) & (F.col("g.rule") == F.col("m.rule")), "left")
    met = met.join(w, F.col("g.rule") == F.col("w.rule"), "left")

    def level(column: str) -> Column:
        return (
            F.when(F.col("f.docs") >= MIN_GROUP, F.col(f"f.{column}"))
            .when(F.col("m.docs") >= MIN_GROUP, F.col(f"m.{column}"))
            .otherwise(F.col(f"w.{column}"))
        )

    chosen = met.select(F.col(f"g.{lang}").alias(lang), F.col(f"g.{source}").alias(source), F.col("g.rule").alias("rule"), level("low").alias("low"), level("high").alias("high"))
    limits = []
    for r in rules:
        own, spread = F.col("rule") == r.name, (F.col("high") - F.col("low")) * r.reach + r.margin
        below = F.col("low") - spread if r.below else F.lit(None).cast("long")
        limits.append(F.max(F.when(own, below)).alias(f"{r.name}_from"))
        limits.append(F.max(F.when(own, F.col("high") + spread)).alias(f"{r.name}_to"))
    return stage(chosen.groupBy(*keys).agg(*limits), "thresholds")


def judged(frame: DataFrame, limits: DataFrame, rules: tuple[Rule, ...] = RULES, lang: str = "lang", source: str = "source") -> DataFrame:
    """The frame, which has the counts, with base_failed and kept added."""
    known = limits.withColumnsRenamed({lang: "__lang", source: "__source"})
    met = frame.join(
        known, F.col(lang).eqNullSafe(F.col("__lang")) & F.col(source).eqNullSafe(F.col("__source")), "left"
    )
    broken = F.lit(False)
    for r in rules:
        value = F.when(F.expr(r.applies), F.expr(r.value))
        broken = broken | F.coalesce(value > F.col(f"{r.name}_to"), F.lit(False))
        broken = broken | F.coalesce(value < F.col(f"{r.name}_from"), F.lit(False))
    met = met.withColumn("base_failed", F.expr(BASE_FAILED))
    met = met.withColumn("kept", ~F.col("base_failed") & ~broken)
    return met.drop("__lang", "__source", *known.columns)


def assessed(documents: DataFrame, key: str = "doc_id", lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed and kept of each row.

    A null or blank text has counts of zero and fails the base rules. Null languages or sources are groups of their
    own. Repeated rows are judged alike and all returned. An empty table gives an empty result.
    """
    kept = documents.select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    features = stage(counted(kept, ("doc_id", "lang", "source")), "features")
    return judged(features, thresholds(features)).select("doc_id", *COUNTS, "base_failed", "kept")


def passed(documents: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """The rows that are kept, with their own columns only.

    Texts are counted twice, once for the sketches and once beside the row, so that no row with its text is shuffled
    or matched by a key; the limits are a small staged table, which Spark broadcasts if its size allows.
    """
    columns = documents.columns
    plain = documents.select(*(F.col(c).alias(f"__{i}") for i, c in enumerate(columns)), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text"))
    own = tuple(f"__{i}" for i in range(len(columns)))
    limits = thresholds(stage(counted(plain, ("lang", "source")), "features"))
    good = judged(counted(plain, (*own, "lang", "source")), limits).where("kept")
    return good.select(*(F.col(f"__{i}").alias(c) for i, c in enumerate(columns)))
