"""Lines that are frequent on their own site: pages with the line, divided by the pages of the host.

A line is compared without blanks around it, by a 64-bit hash, and counts once per distinct page. Lines above the ratio
are gathered per host; since each must be on a share of the host's pages, a host has at most (lines per page / ratio) of
them, so one array per host is bounded by the length of its pages. Pages meet their host's array and are filtered in
place: texts are never taken apart into rows that would have to be put together again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallbook.plans.staging import stage

RATIO, LEAST_PAGES = 0.1, 2
# Of a source, which is many sites: the ratio of a line of one character, divided by the characters, down to a lowest ratio;
# the fewest texts that show boilerplate by themselves; and which part of the texts must differ around the line.
PER_LENGTH, LOWEST, LEAST_TEXTS, APART = 0.3, 0.005, 5, 3
# A text is known by the smallest of its lines' hashes, under so many hash functions.
_HASHES = 4
_BLANKS = " \t\r"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hashes(lines: Column) -> Column:
    """Hashes of the lines with anything on them, each once."""
    filled = F.filter(F.transform(lines, lambda x: F.btrim(x, F.lit(_BLANKS))), lambda x: x != "")
    return F.transform(F.array_distinct(filled), lambda x: F.xxhash64(x))


def frequent_lines(pages: DataFrame, host: str, text: str, ratio: float = RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """(host, lines): hashes of the lines on more than `ratio` of the host's pages, and on `least` of them.

    Pages of a host with equal text are one page, so that copies of a page don't make its lines boilerplate.
    """
    known = pages.where(F.col(host).isNotNull()).select(
        F.col(host).alias("host"), F.xxhash64(F.col(text)).alias("page"), _hashes(lines_of(F.col(text))).alias("lines")
    )
    once = stage(known.groupBy("host", "page").agg(F.first("lines").alias("lines")), "page-lines")
    totals = once.groupBy("host").agg(F.count("*").alias("pages"))
    counts = (
        once.select("host", F.explode("lines").alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("with_line")).where(F.col("with_line") >= least)
    )
    over = counts.join(totals, "host").where(F.col("with_line") > F.col("pages") * F.lit(ratio))
    return over.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def frequent_in_sources(texts: DataFrame, source: str, text: str) -> DataFrame:
    """(host, lines) as frequent_lines, by a ratio for whole sources.

    A source is many sites, so the boilerplate of one site is on a small share of it; but a long line is hardly repeated by
    chance. The ratio falls with the line's length: PER_LENGTH / characters, RATIO at most and LOWEST at least, and a line
    under RATIO must be in LEAST_TEXTS distinct texts. Near-copies of a text repeat all its lines without any being
    boilerplate: of the texts with a line under RATIO, one in APART at least must be different around it. Two texts count
    as different where the smallest hash of their other lines is; for texts that share most lines it mostly is the same.

    A line above RATIO in fewer texts than LEAST_TEXTS, as small sources have it, goes if _apart_in_few finds two texts
    around it that are no copies.
    """
    bare = F.filter(F.transform(lines_of(F.col(text)), lambda x: F.btrim(x, F.lit(_BLANKS))), lambda x: x != "")
    cap = math.ceil(PER_LENGTH / LOWEST)
    sized = F.transform(
        F.array_distinct(bare),
        lambda x: F.struct(F.xxhash64(x).alias("line"), F.least(F.length(x), F.lit(cap)).cast("short").alias("size")),
    )
    known = texts.where(F.col(source).isNotNull()).select(
        F.col(source).alias("host"), F.xxhash64(F.col(text)).alias("page"), sized.alias("lines")
    )
    once = stage(known.groupBy("host", "page").agg(F.first("lines").alias("lines")), "text-lines")
    totals = once.groupBy("host").agg(F.count("*").alias("pages"))
    counts = (
        once.select("host", F.explode("lines").alias("x"))
        .groupBy("host", F.col("x.line").alias("line"), F.col("x.size").alias("size"))
        .agg(F.count("*").alias("with_line")).where(F.col("with_line") >= LEAST_PAGES)
    )
    ratio = F.least(F.greatest(F.lit(PER_LENGTH) / F.col("size"), F.lit(LOWEST)), F.lit(RATIO))
    over, few = F.col("with_line") > F.col("pages") * RATIO, F.col("with_line") < LEAST_TEXTS
    often = counts.join(totals, "host").where((F.col("with_line") > F.col("pages") * ratio) & (over | ~few))
    often = stage(often.select("host", "line", "with_line", (over & ~few).alias("sure"), few.alias("few")), "often")

    def two_smallest(seed: int) -> Column:
        found = F.transform("lines", lambda x: F.struct(F.xxhash64(x["line"], F.lit(seed)).alias("hash"), x["line"].alias("line")))
        return F.slice(F.array_sort(found), 1, 2)

    # (line, hash of the rest by each function): the second smallest where the line itself has the smallest
    held = once.select("host", "lines", F.array(*(two_smallest(i) for i in range(_HASHES))).alias("least"))
    held = held.select("host", "least", F.explode("lines.line").alias("line"))
    met = held.join(often.where("not sure and not few"), ["host", "line"])
    rest = F.transform("least", lambda x: F.filter(x, lambda y: y["line"] != F.col("line"))[0]["hash"])
    around = met.select("host", "line", "with_line", F.posexplode(rest).alias("function", "hash")).where("hash is not null")
    kinds = around.groupBy("host", "line", "with_line", "function", "hash").agg(F.lit(1).alias("one"))
    kinds = kinds.groupBy("host", "line", "with_line", "function").agg(F.count("*").alias("kinds"))
    apart = kinds.where((F.col("kinds") >= LEAST_TEXTS) & (F.col("kinds") * APART >= F.col("with_line"))).select("host", "line").distinct()
    found = often.where("sure").select("host", "line").union(apart).union(_apart_in_few(once, often))
    return found.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def _apart_in_few(once: DataFrame, often: DataFrame) -> DataFrame:
    """(host, line) of the `few` lines that stand in two texts that are no copies of each other.

    Two texts are copies if they share more than half of the lines of the shorter one, the lines of many texts left out.
    A line of few texts above RATIO has a host of few texts, and at most six pairs of texts.
    """
    few = often.where("few").select("host", "line")
    lines = once.join(few.select("host").distinct(), "host", "left_semi").select("host", "page", F.explode("lines.line").alias("line"))
    rare = lines.join(often.where("sure").select("host", "line"), ["host", "line"], "left_anti")
    sizes = rare.groupBy("host", "page").agg(F.count("*").alias("size"))
    texts = rare.join(few, ["host", "line"]).groupBy("host", "line").agg(F.sort_array(F.collect_list("page")).alias("texts"))
    later = F.transform(
        "texts", lambda a, i: F.transform(F.slice("texts", i + 2, LEAST_TEXTS), lambda b: F.struct(a.alias("a"), b.alias("b")))
    )
    pairs = texts.select("host", "line", F.explode(F.flatten(later)).alias("pair")).select("host", "line", "pair.a", "pair.b")
    shared = pairs.groupBy("host", "a", "b").agg(F.count("*").alias("shared"))
    for side in ("a", "b"):
        shared = shared.join(sizes.select("host", F.col("page").alias(side), F.col("size").alias(f"of_{side}")), ["host", side])
    apart = shared.where(2 * F.col("shared") <= F.least("of_a", "of_b")).select("host", "a", "b")
    return pairs.join(apart, ["host", "a", "b"], "left_semi").select("host", "line").distinct()


def without_boilerplate(
    pages: DataFrame,
    host: str,
    text: str,
    ratio: float = RATIO,
    least: int = LEAST_PAGES,
    dropped: str | None = None,
    sources: bool = False,
) -> DataFrame:
    """The rows with frequent lines taken out of the text; all columns stay, `dropped` adds the number of lines gone.

    With `sources` the lines are those of frequent_in_sources, which has its own ratio and least count. Rows without host are left as they are. A null text stays null but counts as a page. Lines are those between \\n;
    blank lines are never dropped. Repeated rows are pages each. An empty table gives an empty result.
    """
    frequent = frequent_in_sources(pages, host, text) if sources else frequent_lines(pages, host, text, ratio, least)
    found = stage(frequent, "boilerplate")
    found = found.select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    met = pages.join(found, F.col(host) == F.col("__host"), "left")

    def stays(line: Column) -> Column:
        return ~F.array_contains("__lines", F.xxhash64(F.btrim(line, F.lit(_BLANKS)))) | (F.btrim(line, F.lit(_BLANKS)) == "")

    lines = lines_of(F.col(text))
    kept = F.when(F.col("__lines").isNull(), lines).otherwise(F.filter(lines, stays))
    met = met.withColumn("__kept", kept)
    added = {text: F.array_join("__kept", "\n")}
    if dropped:
        added[dropped] = F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)).cast("long")
    return met.withColumns(added).drop("__host", "__lines", "__kept")


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; null without one."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def lines_of_html(html: Column) -> Column:
    """The text of a page, a line for what stands between tags; scripts, styles and comments are left out."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "\n")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", "\n"), r"[ \t\r]*\n[ \t\r\n]*", "\n")
