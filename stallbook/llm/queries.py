"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm import boilerplate, byte_bpe, langid, licenses, minmax, mixing, neighbours, packing, pii, prefix_trie, quality, secrets, spelling

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    # room for the words of a large part of the texts: nothing else of the query takes memory
    return packing.packed(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), remembered=1_000_000)


def op2_boilerplate(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select(
        "page_id", boilerplate.host_of(F.col("url")).alias("host"), boilerplate.lines_of_html(F.col("html")).alias("text")
    )
    return boilerplate.without_boilerplate(pages, "host", "text", dropped="n_dropped")


def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(_table(spark, folder, "documents"))


def op4_minmax(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(_table(spark, folder, "documents"), width=2, percent=80)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assessed(_table(spark, folder, "documents"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.found_in(_table(spark, folder, "documents"))


def op7_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.labelled(_table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digested(secrets.scanned(_table(spark, folder, "documents")))


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.counted(_table(spark, folder, "documents")))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = prefix_trie.numbered(_table(spark, folder, "conversations"))
    return prefix_trie.prefix_nodes(prefix_trie.branched(turns))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    texts = _table(spark, folder, "documents").select("doc_id", "text")
    return byte_bpe.digested(byte_bpe.decoded(byte_bpe.encoded(texts, ranks, pattern), ranks, pattern))


def queries() -> dict[str, Query]:
    return {
        "op1_packing": op1_packing,
        "op2_boilerplate": op2_boilerplate,
        "op3_licenses": op3_licenses,
        "op4_minmax": op4_minmax,
        "op5_quality": op5_quality,
        "op6_pii": op6_pii,
        "op7_neighbours": op7_neighbours,
        "op8_mixing": op8_mixing,
        "op9_langid": op9_langid,
        "op10_secrets": op10_secrets,
        "op11_spelling": op11_spelling,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_byte_bpe": op13_byte_bpe,
    }


BOILERPLATE_SQL = r"""
WITH bare AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', chr(10), 'g') AS html
  FROM pages
), texts AS (
  SELECT page_id, host,
    regexp_replace(regexp_replace(html, '<[^>]*>', chr(10), 'g'), '[ \t\r]*\n[ \t\r\n]*', chr(10), 'g') AS text,
    row_number() OVER () AS page
  FROM bare
), lines AS (
  SELECT page, host, u.line, u.n, trim(u.line, ' ' || chr(9) || chr(13)) AS bare
  FROM texts, LATERAL (
    SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
  ) u
), first_pages AS (
  SELECT host, min(page) AS page FROM texts WHERE host IS NOT NULL GROUP BY host, text
), totals AS (
  SELECT host, count(*) AS pages FROM first_pages GROUP BY host
), frequent AS (
  SELECT l.host, l.bare FROM lines l JOIN first_pages f ON l.page = f.page JOIN totals t ON l.host = t.host
  WHERE l.bare <> '' GROUP BY l.host, l.bare, t.pages
  HAVING count(DISTINCT l.page) >= 2 AND count(DISTINCT l.page) > t.pages * 0.1
), kept AS (
  SELECT l.page, string_agg(l.line, chr(10) ORDER BY l.n) FILTER (WHERE f.bare IS NULL) AS text,
    count(f.bare) AS n_dropped
  FROM lines l LEFT JOIN frequent f ON l.host = f.host AND l.bare = f.bare GROUP BY l.page
)
SELECT t.page_id, t.host, CASE WHEN t.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
  coalesce(k.n_dropped, 0)::BIGINT AS n_dropped
FROM texts t LEFT JOIN kept k ON t.page = k.page
"""

NEIGHBOURS_SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), normed AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM usable
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v) / (q.n * c.n) AS score
  FROM normed q JOIN normed c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


_WORDS = r"regexp_extract_all({}, '[^ \t\n\x0B\f\r]+')"

MINMAX_SQL = f"""
WITH RECURSIVE tokens AS (
  SELECT doc_id,
    {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), listed AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
    ELSE list_distinct([[w[i], w[i + 1]] FOR i IN range(1, len(w))]) END) AS s FROM tokens
), numbered AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY s) AS s FROM listed
), sizes AS (
  SELECT t.doc_id, count(n.s) AS n FROM tokens t LEFT JOIN numbered n ON t.doc_id = n.doc_id GROUP BY t.doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM numbered a JOIN numbered b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes UNION SELECT r.a, w.b FROM reached r JOIN both_ways w ON r.b = w.a
), lowest AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a
)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN lowest USING (doc_id)
"""


def _bucket(value: str) -> str:
    shift = f"greatest(length(bin({value})) - 7, 0)"
    return f"({shift} * 64 + ({value} >> {shift}))"


def _floor(bucket: str) -> str:
    shift = f"greatest({bucket} // 64 - 1, 0)"
    return f"(({bucket} - {shift} * 64) << {shift})"


# fixed values: the rules of the operator, written out anew: name, value, quantiles in hundredths, how many times their
# distance, margin, texts, whether there is a lower limit
_JUDGED = [
    ("word_length", "word_chars * 100 // n_words", 25, 75, 3, 50, "n_words >= 50", True),
    ("symbols", "n_symbols * 1000 // n_words", 50, 75, 3, 20, "n_words >= 10", False),
    ("repeated_lines", "n_dup_lines * 1000 // n_lines", 90, 99, 1, 20, "n_lines >= 5", False),
    ("repeated_words", "n_repeat_words * 1000 // n_words", 90, 99, 1, 10, "n_words >= 10", False),
]


def _share(side: str) -> str:
    shares = " ".join(f"WHEN '{r}' THEN {low if side == 'low' else high}" for r, _, low, high, *_ in _JUDGED)
    return f"CASE rule {shares} END"


def _fences(name: str, keys: str) -> str:
    by = f"{keys}, " if keys else ""
    return f"""{name} AS (
  SELECT {by}rule, max(total) AS docs,
    {_floor(f"min(b) FILTER (WHERE up_to * 100 >= total * {_share('low')})")} AS low,
    {_floor(f"min(b) FILTER (WHERE up_to * 100 >= total * {_share('high')})")} AS high
  FROM (
    SELECT {by}rule, b, sum(n) OVER (PARTITION BY {by}rule ORDER BY b) AS up_to, sum(n) OVER (PARTITION BY {by}rule) AS total
    FROM (SELECT {by}rule, b, sum(n)::BIGINT AS n FROM sketch GROUP BY {by}rule, b)
  ) GROUP BY {by}rule
)"""


_VALUES = " UNION ALL ".join(
    f"SELECT id, lang, source, base_failed, '{r}' AS rule, {v} AS v, {n} AS reach, {m} AS margin, {b} AS below FROM based WHERE {w}"
    for r, v, _, _, n, m, w, b in _JUDGED
)

QUALITY_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS id, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT id, doc_id, lang, source, text, {_WORDS.format("text")} AS w, string_split(text, chr(10)) AS l FROM texts
), windows AS (
  SELECT id, i, [w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]] AS five
  FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)
), repeated AS (
  SELECT id, unnest(range(i, i + 5)) AS place FROM (SELECT id, i, count(*) OVER (PARTITION BY id, five) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT id, count(DISTINCT place) AS n FROM repeated GROUP BY id
), lines AS (
  SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT id, unnest(l) AS line FROM split) WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]') GROUP BY id
), counts AS (
  SELECT s.id, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN lines ON s.id = lines.id LEFT JOIN covered c ON s.id = c.id
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
), vals AS ({_VALUES}), sketch AS (
  SELECT lang, source, rule, {_bucket("v")} AS b, count(*) AS n FROM vals WHERE NOT base_failed GROUP BY ALL
), {_fences("fine", "lang, source")}, {_fences("middle", "lang")}, {_fences("whole", "")},
limits AS (
  SELECT g.lang, g.source, w.rule,
    CASE WHEN f.docs >= 200 THEN f.low WHEN m.docs >= 200 THEN m.low ELSE w.low END AS low,
    CASE WHEN f.docs >= 200 THEN f.high WHEN m.docs >= 200 THEN m.high ELSE w.high END AS high
  FROM (SELECT DISTINCT lang, source FROM texts) g JOIN whole w ON TRUE
  LEFT JOIN fine f ON f.lang IS NOT DISTINCT FROM g.lang AND f.source IS NOT DISTINCT FROM g.source AND f.rule = w.rule
  LEFT JOIN middle m ON m.lang IS NOT DISTINCT FROM g.lang AND m.rule = w.rule
), broken AS (
  SELECT DISTINCT v.id FROM vals v JOIN limits k
    ON v.rule = k.rule AND v.lang IS NOT DISTINCT FROM k.lang AND v.source IS NOT DISTINCT FROM k.source
  WHERE v.v > high + (high - low) * reach + margin OR (below AND v.v < low - (high - low) * reach - margin)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND id NOT IN (SELECT id FROM broken) AS kept
FROM based
"""


def _secrets_sql() -> str:
    """Every rule's pattern over every text, without the index."""
    found = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        found.append(
            f"SELECT id, {rank} AS rank, '{rule.kind}' AS kind, regexp_extract_all(text, '{pattern}', 0) AS found, "
            f"regexp_extract_all(text, '{pattern}', {rule.group}) AS val, string_split_regex(text, '{pattern}') AS gap, "
            f"{rule.least} AS least FROM texts"
        )
    return f"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
matches AS ({" UNION ALL ".join(found)}),
each AS (
  SELECT id, rank, kind, least, i, length(found[i]) AS size, length(val[i]) AS inner_size, length(gap[i]) AS gap_size
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM matches)
),
spans AS (
  SELECT id, rank, kind, least, inner_size, size,
    (sum(gap_size + size) OVER (PARTITION BY id, rank ORDER BY i) - size)::BIGINT AS s FROM each
),
good AS (SELECT id, rank, s, kind || ':' || s || ':' || (s + size) AS span FROM spans WHERE inner_size >= least),
joined AS (
  SELECT id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
    count(*) FILTER (WHERE rank = 2) AS n_hex, string_agg(span, ',' ORDER BY s, rank) FILTER (WHERE rank < 3) AS base,
    string_agg(span, ',' ORDER BY s, rank) AS spans
  FROM good GROUP BY id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined ON texts.id = joined.id
"""


def _crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII or Latin-1 text's UTF-8 bytes; needs crc_table as a list in `t.steps`."""
    point = "ord(s)"
    octets = f"CASE WHEN {point} < 128 THEN [{point}] ELSE [192 + {point} // 64, 128 + {point} % 64] END"
    listed = f"flatten(list_transform(string_split({text}, ''), lambda s: {octets}))"
    step = "xor(t.steps[(xor(x, y) & 255) + 1], x >> 8)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {listed}::BIGINT[]), lambda x, y: {step}), 4294967295)"


CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_concat([n], [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY n) AS steps
  FROM (SELECT unnest(range(256))::BIGINT AS n)
)"""

SPELLING_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-zÀ-ÿ]+')) AS run FROM documents
), each AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL
), drawn AS (
  SELECT run, n, {_crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM each CROSS JOIN crc_table t
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM drawn
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), links AS (
  SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word < b.word
  UNION SELECT a.word, a.n, g.word, g.n FROM words a JOIN gaps g ON g.rest = a.word
), sides AS (
  SELECT a AS word, an AS n, b AS other, bn AS other_n FROM links UNION ALL SELECT b, bn, a, an FROM links
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM sides GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n FROM words w LEFT JOIN best b USING (word)
), steps AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.next
)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM forms f JOIN steps s ON s.word = f.word AND s.next IS NULL
"""

PREFIX_SQL = f"""
WITH {CRC_TABLE}, said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    dense_rank() OVER (ORDER BY role, text) AS kind, strlen(text) AS size FROM said
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS giver, {_crc32_sql("conv_id::VARCHAR")} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns) CROSS JOIN crc_table t
), rebuilt AS (
  SELECT c.conv_id, s.place, s.kind FROM convs c JOIN turns s ON s.conv_id = c.conv_id
  WHERE s.place > c.h OR c.giver = c.conv_id
  UNION ALL
  SELECT c.conv_id, s.place, s.kind FROM convs c JOIN turns s ON s.conv_id = c.giver
  WHERE s.place <= c.h AND c.giver <> c.conv_id
), paths AS (
  SELECT c.conv_id, coalesce(list(r.kind ORDER BY r.place) FILTER (WHERE r.kind IS NOT NULL), []) AS path
  FROM convs c LEFT JOIN rebuilt r USING (conv_id) GROUP BY c.conv_id
), members AS (
  SELECT conv_id, len(path) AS turns, unnest(range(len(path) + 1)) AS depth, path FROM paths
), nodes AS (
  SELECT path[:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
  FROM members GROUP BY ALL
), kinds AS (
  SELECT DISTINCT kind, size FROM turns
), sized AS (
  SELECT n.*, (n.n_convs - 1) * coalesce(k.size, 0) AS saved, CASE WHEN depth > 0 THEN node[:depth - 1] END AS parent
  FROM nodes n LEFT JOIN kinds k ON k.kind = n.node[n.depth]
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM sized WHERE parent IS NOT NULL GROUP BY parent
), counted AS (
  SELECT s.*, coalesce(c.n_children, 0) AS n_children FROM sized s LEFT JOIN children c USING (node)
), subtrees AS (
  SELECT top AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT node[:unnest(range(depth + 1))] AS top, n_children, saved FROM counted) GROUP BY top
)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees s USING (node) LEFT JOIN nodes p ON p.node = c.parent
"""


def statements() -> dict[str, str]:
    return {
        "op2_boilerplate": BOILERPLATE_SQL,
        "op4_minmax": MINMAX_SQL,
        "op5_quality": QUALITY_SQL,
        "op7_neighbours": NEIGHBOURS_SQL,
        "op10_secrets": _secrets_sql(),
        "op11_spelling": SPELLING_SQL,
        "op12_prefix_trie": PREFIX_SQL,
    }
