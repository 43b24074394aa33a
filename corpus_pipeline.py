"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that its predecessor kept, written as Parquet and read again. Columns of the documents:
doc_id, text, lang, source, n_chars.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallbook.llm import boilerplate, minmax, mixing, packing, quality
from stallbook.plans.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_SHINGLE, _PERCENT = 5, 80
# About so many rows that agree in id, source and size are numbered by one task.
_PART_ROWS = 4096


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source.

    A null or empty text fails; null languages and sources are groups of their own; repeated rows are judged alike. Other
    columns may have any names. An empty table gives an empty result.
    """
    return quality.passed(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that are boilerplate of their source; a document of nothing else goes.

    A null or empty text and a text without source stay as they are. Other columns may have any names but __dropped. An
    empty table gives an empty result.
    """
    rest = boilerplate.without_boilerplate(docs, "source", "text", dropped="__dropped", sources=True)
    emptied = (F.col("__dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return rest.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id. Repeated rows are one.

    A row without id, and one whose text has no words, is nobody's duplicate and stays. Different texts of one id are
    judged each for itself; the id goes if one of them goes. Other columns may have any names. An empty table gives an
    empty result.
    """
    found = minmax.near_duplicates(docs, width=_SHINGLE, percent=_PERCENT)
    kinds = found.groupBy("doc_id").agg(F.bool_and("kept").alias("__stays"), F.count("*").alias("__rows"))
    odd = stage(kinds.where("doc_id is not null and (not __stays or __rows > 1)"), "near-duplicates")
    single = docs.join(odd, "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.join(odd.where("__stays"), "doc_id", "left_semi").select(*docs.columns).distinct()
    return single.union(repeated)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice.

    Rows that agree in id, source and size take their copies together. Where these are no multiple of the rows, the rows
    with the smallest hashes of their texts take one copy more than the others. A null text has size 0 and is not taken;
    null ids and sources agree with each other. Other columns may have any names. An empty table gives an empty result.
    """
    own = ["__id", "__source", "__size"]
    taken = mixing.mixed(docs).select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("copies").alias("__taken"))
    taken = stage(taken.groupBy(*own).agg(F.sum("__taken").alias("__copies"), F.count("*").alias("__rows")), "mix")
    even = F.col("__copies") % F.col("__rows") == 0
    each_row = F.floor(F.col("__copies") / F.col("__rows"))
    sized = docs.withColumns({"__id": F.col("doc_id"), "__source": F.col("source"), "__size": mixing.words_in("text")})

    def met(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
        """Inner join on id, source, size and more, where nulls agree."""
        keys = [*own, *more]
        r = right.withColumnsRenamed({c: f"{c}_of" for c in keys})
        joined = left.join(r, [F.col(c).eqNullSafe(F.col(f"{c}_of")) for c in keys])
        return joined.drop(*(f"{c}_of" for c in keys))

    def repeated(rows: DataFrame, times: Column) -> DataFrame:
        each = F.when(times > 0, F.sequence(F.lit(1), times.cast("int"))).otherwise(F.array().cast("array<int>"))
        return rows.withColumn("__time", F.explode(each)).select(*docs.columns)

    # what is taken grows with the documents: it is matched by a shuffle at every size
    whole = repeated(met(sized, taken.where(even & (F.col("__copies") > 0)).hint("merge")), each_row)

    # many rows of one key are dealt over parts by the hashes of their texts; each part takes its share of what is left over
    odd = taken.where(~even).withColumn("__parts", F.ceil(F.col("__rows") / _PART_ROWS).cast("long"))
    hashed = sized.withColumn("__hash", F.xxhash64("text"))
    width = F.floor(F.lit(2.0**64) / F.col("__parts"))
    part = F.least(F.floor((F.col("__hash") + F.lit(2.0**63)) / width), F.col("__parts") - 1)
    dealt = met(hashed.select(*own, "__hash"), odd).withColumn("__part", part)
    counts = dealt.groupBy(*own, "__part", "__copies", "__rows").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*own).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    left_over = F.col("__copies") % F.col("__rows") - F.coalesce(F.sum("__n").over(earlier), F.lit(0))
    shares = stage(counts.withColumn("__more", left_over).select(*own, "__part", "__copies", "__rows", "__more"), "mix-shares")
    parts = stage(odd.select(*own, "__parts"), "mix-parts")
    placed = met(hashed, parts).withColumn("__part", part)
    ordered = Window.partitionBy(*own, "__part").orderBy("__hash")
    rows = met(placed, shares, "__part").withColumn("__place", F.row_number().over(ordered))
    return whole.union(repeated(rows, each_row + (F.col("__place") <= F.col("__more")).cast("int")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens.

    A null or empty text has its end alone. Other columns are not read. An empty table gives an empty result.
    """
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("source mix", source_mix),
    ("packing", pack),
]

# Tokens and sampling have no SQL form: the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of the folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
