"""Query registry: one Spark builder per operator id, with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Builders only read the given tables (or data Spark derives from them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentforge.operators import sentences as sent
from sentforge.operators import tokens as tok
from sentforge.plans import oracle_sql as o
from sentforge.plans.tables import default_tokens, doc_lines, documents, table

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- tokens ----
def neg_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tok.negative_tokens(documents(spark, sf_dir), default_tokens(spark))


register("negative_tokens", _with(o.negative_tokens_cte()) + "SELECT token FROM neg_tokens")(neg_tokens)


# ------------------------------------------------------------- sentences ----
def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sent.sentence_split(doc_lines(spark, sf_dir), neg_tokens(spark, sf_dir))


_SENT_CTES = (o.negative_tokens_cte(), o.DOC_LINES, o.sentence_words_cte("doc_lines", "doc_id, line_no", "neg_tokens"))


@register("sentence_extract", _with(*_SENT_CTES) + "SELECT DISTINCT sentence FROM sent")
def q_sentence_extract(spark, sf_dir):
    return _sentences(spark, sf_dir).select("sentence").distinct()


@register(
    "sentence_counts",
    _with(*_SENT_CTES) + "SELECT sentence, count(*)::BIGINT AS n FROM sent GROUP BY sentence",
)
def q_sentence_counts(spark, sf_dir):
    return _sentences(spark, sf_dir).groupBy("sentence").agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------- matching ----
from sentforge.operators import match as mt  # noqa: E402
from sentforge.plans.tables import bench_lines  # noqa: E402


def _pdf_lines(spark, sf_dir):
    return doc_lines(spark, sf_dir).select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("filename"), F.col("line").alias("sentence")
    )


def _ik_lines(spark, sf_dir):
    return bench_lines(spark, sf_dir).select(F.col("line").alias("sentence"))


_EXACT_SQL = _with(o.DOC_LINES, o.BENCH_LINES) + f"""
, l AS (SELECT 'doc_' || doc_id::VARCHAR AS filename, line AS sentence, {o.normal_form('line')} AS clean,
               len(string_split(line, ' ')) AS wc
        FROM doc_lines WHERE regexp_matches(line, '[A-Za-z]'))
, r AS (SELECT line AS sentence, {o.normal_form('line')} AS clean FROM bench_lines WHERE regexp_matches(line, '[A-Za-z]'))
SELECT l.sentence AS pdf_sentence, r.sentence AS ik_sentence, sha256(l.clean) AS norm_hash, l.filename
FROM l JOIN r ON l.clean = r.clean WHERE l.wc > 4 AND l.clean <> '' AND r.clean <> ''"""


@register("exact_match", _EXACT_SQL)
def q_exact_match(spark, sf_dir):
    return mt.exact_match(_pdf_lines(spark, sf_dir), _ik_lines(spark, sf_dir))


def _near_sides(spark, sf_dir):
    landed = doc_lines(spark, sf_dir).select(F.col("line").alias("sentence"))
    return _ik_lines(spark, sf_dir), landed


def _bigram_set(x: str) -> str:
    return f"list_distinct(list_transform(range(1, length(lower({x}))), lambda i: substr(lower({x}), i, 2)))"


_NEAR_SQL = _with(o.DOC_LINES, o.BENCH_LINES) + f"""
, a AS (SELECT DISTINCT line AS text FROM bench_lines WHERE regexp_matches(line, '[A-Za-z]') AND length(line) >= 2)
, b AS (SELECT DISTINCT line AS text FROM doc_lines
        WHERE regexp_matches(line, '[A-Za-z]') AND length(line) >= 2)
, ag AS (SELECT text, {_bigram_set('text')} AS g FROM a)
, bg AS (SELECT text, {_bigram_set('text')} AS g FROM b)
, pairs AS (SELECT ag.text AS ik_sentence, bg.text AS pdf_sentence, len(ag.g) AS na, len(bg.g) AS nb,
                   len(list_intersect(ag.g, bg.g)) AS inter FROM ag, bg)
SELECT ik_sentence, pdf_sentence, 1.0 - inter::DOUBLE / (na + nb - inter)::DOUBLE AS confidence
FROM pairs WHERE 1.0 - inter::DOUBLE / (na + nb - inter)::DOUBLE < 0.5"""


@register("near_match", _NEAR_SQL)
def q_near_match(spark, sf_dir):
    a, b = _near_sides(spark, sf_dir)
    return mt.near_match(a, b, 0.5)


@register("near_match_lsh")
def q_near_match_lsh(spark, sf_dir):
    a, b = _near_sides(spark, sf_dir)
    return mt.near_match_lsh(a, b, 0.5)


# ------------------------------------------------------------- alignment ----
from sentforge.operators import align as al  # noqa: E402
from sentforge.operators import memory as mem  # noqa: E402

# Test binding of the ten languages: documents of source src0..src9.
LANG_SOURCES = {f"src{i}": lang for i, lang in enumerate(al.LANGUAGES)}
_LANG_MAP_SQL = (
    "(SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{l}')" for s, l in LANG_SOURCES.items()) + ") v(source, lang))"
)
# The pivot's binding: two sources per language, all twenty in use.
PIVOT_SOURCES = {f"src{i}": al.LANGUAGES[i % len(al.LANGUAGES)] for i in range(20)}
_PIVOT_MAP_SQL = (
    "(SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{l}')" for s, l in PIVOT_SOURCES.items()) + ") v(source, lang))"
)
_NF = o.normal_form


def _lang_of(col: str):
    expr = None
    for s, lang in PIVOT_SOURCES.items():
        expr = (F.when(F.col(col) == s, lang) if expr is None else expr.when(F.col(col) == s, lang))
    return expr


def _next_lines(spark, sf_dir):
    """Target side of a document's parallel text: line i+1 under id i."""
    return doc_lines(spark, sf_dir).select("doc_id", (F.col("line_no") - 1).alias("line_no"), "line")


def _clean(spark, sf_dir):
    return _ik_lines(spark, sf_dir)


@register(
    "line_align",
    """SELECT DISTINCT s.text AS src_sentence, t.text AS tgt_sentence
FROM conversations s JOIN conversations t ON s.conv_id = t.conv_id AND t.turn - 1 = s.turn""",
)
def q_line_align(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    src = c.select("conv_id", "turn", F.col("text").alias("line"))
    tgt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("line"))
    return al.line_align(src, tgt, ["conv_id", "turn"])


_ALIGN_CTES = (o.DOC_LINES, o.BENCH_LINES, f"""clean_norm AS (
  SELECT DISTINCT {_NF('line')} AS n FROM bench_lines WHERE {_NF('line')} <> '')""")


@register(
    "align_filtered",
    _with(*_ALIGN_CTES) + f"""
, s AS (SELECT doc_id, line_no, {_NF('line')} AS src_sentence FROM doc_lines
        WHERE {_NF('line')} IN (SELECT n FROM clean_norm))
, t AS (SELECT doc_id, line_no - 1 AS line_no, line AS tgt_sentence FROM doc_lines)
SELECT DISTINCT src_sentence, tgt_sentence FROM s JOIN t USING (doc_id, line_no)""",
)
def q_align_filtered(spark, sf_dir):
    return al.align_filtered(_clean(spark, sf_dir), doc_lines(spark, sf_dir), _next_lines(spark, sf_dir), ["doc_id", "line_no"])


_PIVOT_SQL = _with(o.DOC_LINES, f"""repeated AS (SELECT line FROM doc_lines GROUP BY line HAVING count(*) > 1),
clean_norm AS (SELECT DISTINCT {_NF('line')} AS n FROM repeated WHERE {_NF('line')} <> '')""") + f"""
, s AS (SELECT m.lang, d.doc_id, d.line_no, {_NF('d.line')} AS src_sentence
        FROM doc_lines d JOIN {_PIVOT_MAP_SQL} m USING (source)
        WHERE {_NF('d.line')} IN (SELECT n FROM clean_norm))
, t AS (SELECT doc_id, line_no - 1 AS line_no, line AS tgt_sentence FROM doc_lines)
, al AS (SELECT DISTINCT lang, src_sentence, tgt_sentence FROM s JOIN t USING (doc_id, line_no)
         WHERE tgt_sentence IS NOT NULL)
, r AS (SELECT *, row_number() OVER (PARTITION BY src_sentence, lang
                                      ORDER BY substr(sha256(tgt_sentence), 1, 2), tgt_sentence) AS k FROM al)
, w AS (SELECT src_sentence, k, {', '.join(f"max(CASE WHEN lang = '{x}' THEN tgt_sentence END) AS {x}" for x in al.LANGUAGES)}
        FROM r GROUP BY src_sentence, k)
SELECT b.line AS pdf_sentence, w.k, {', '.join('w.' + x for x in al.LANGUAGES)}
FROM repeated b LEFT JOIN w ON {_NF('b.line')} = w.src_sentence"""


@register("language_pivot", _PIVOT_SQL)
def q_language_pivot(spark, sf_dir):
    src = doc_lines(spark, sf_dir).withColumn("lang", _lang_of("source")).filter(F.col("lang").isNotNull())
    # the clean list: lines that occur more than once
    clean = doc_lines(spark, sf_dir).groupBy(F.col("line").alias("sentence")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    aligned = al.align_filtered(clean, src, _next_lines(spark, sf_dir), ["doc_id", "line_no"], carry=["lang"])
    return al.language_pivot(clean, aligned)


_ALIGNED_ALL = """aligned AS (
  SELECT DISTINCT s.line AS src_sentence, t.line AS tgt_sentence
  FROM doc_lines s JOIN doc_lines t ON s.doc_id = t.doc_id AND t.line_no = s.line_no + 1)"""


def _aligned_all(spark, sf_dir):
    return al.line_align(doc_lines(spark, sf_dir), _next_lines(spark, sf_dir), ["doc_id", "line_no"])


@register(
    "overlap",
    _with(o.DOC_LINES, o.BENCH_LINES, _ALIGNED_ALL) + f"""
SELECT b.line AS pdf_sentence, a.tgt_sentence, sha256({_NF('b.line')}) AS norm_hash
FROM bench_lines b LEFT JOIN aligned a ON b.line = a.src_sentence""",
)
def q_overlap(spark, sf_dir):
    return al.overlap(_clean(spark, sf_dir), _aligned_all(spark, sf_dir), how="left")


@register(
    "overlap_inner",
    _with(o.DOC_LINES, o.BENCH_LINES, _ALIGNED_ALL) + """
SELECT DISTINCT b.line AS pdf_sentence, a.tgt_sentence FROM bench_lines b JOIN aligned a ON b.line = a.src_sentence""",
)
def q_overlap_inner(spark, sf_dir):
    return al.overlap(_clean(spark, sf_dir), _aligned_all(spark, sf_dir), how="inner")


def _pairs(spark, sf_dir):
    """Parallel pairs: a turn and the next turn, metadata JSON from the event
    that shares the conversation id."""
    c = table(spark, sf_dir, "conversations")
    s = c.select("conv_id", "turn", F.col("text").alias("src"), F.col("role").alias("src_lang"))
    t = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"), F.col("role").alias("tgt_lang"))
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("conv_id"), F.col("props").alias("metadata_json"))
    p = s.join(t, ["conv_id", "turn"]).join(e, "conv_id", "left")
    return p.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("sno"),
        "src", "tgt", "src_lang", "tgt_lang", "metadata_json",
    )


_PAIRS_SQL = """pairs AS (
  SELECT sha256(s.text) AS src_hash, s.text AS src, t.text AS tgt, s.role AS src_lang, t.role AS tgt_lang,
         try_cast(json_extract_string(e.props, '$.k') AS BIGINT) AS k
  FROM conversations s JOIN conversations t ON s.conv_id = t.conv_id AND t.turn = s.turn + 1
  LEFT JOIN events e ON e.event_id = s.conv_id)"""


@register("pair_load", _with(_PAIRS_SQL) + "SELECT * FROM pairs")
def q_pair_load(spark, sf_dir):
    return al.pair_load(_pairs(spark, sf_dir), "k bigint")


@register(
    "pair_query",
    _with(_PAIRS_SQL) + """
SELECT src, tgt FROM pairs
WHERE length(src) < 160 AND (CASE WHEN k < 50 THEN 'M' ELSE 'F' END) = 'M'
ORDER BY src, tgt LIMIT 10""",
)
def q_pair_query(spark, sf_dir):
    p = al.pair_load(_pairs(spark, sf_dir), "k bigint").withColumn(
        "label", F.when(F.col("k") < 50, "M").when(F.col("k") >= 50, "F")
    )
    return al.pair_query(p, 160, "label", "M", 10)


# ------------------------------------------------------ translation memory ----
def _translate(col: str):
    """Stand-in for the translation service output (a table in practice)."""
    return F.concat(F.lit("[hi] "), F.col(col))


def _memory(spark, sf_dir, unique=True):
    lines = doc_lines(spark, sf_dir).filter(F.col("source").isin(*LANG_SOURCES) & (F.col("line") != ""))
    return mem.memory_rows(
        lines.select(F.col("line").alias("sentence"), "lang"), _translate("sentence"), F.col("lang"), F.lit("hi"), unique=unique
    )


def _requests(spark, sf_dir):
    return doc_lines(spark, sf_dir).filter(~F.col("source").isin(*LANG_SOURCES) & (F.col("line") != "")).select(
        F.col("line").alias("sentence")
    )


_SRC_IN = "(" + ", ".join(f"'{s}'" for s in LANG_SOURCES) + ")"
_MEM_SQL = f"""mem AS (
  SELECT key, p.t AS target_sentence, p.s AS source_sentence, p.sl AS source_language, p.tl AS target_language
  FROM (SELECT 'hi_' || sha256(line) AS key,
               max(struct_pack(t := '[hi] ' || line, s := line, sl := lang, tl := 'hi')) AS p
        FROM doc_lines WHERE source IN {_SRC_IN} AND line <> '' GROUP BY 1)),
req AS (SELECT DISTINCT line AS source_sentence FROM doc_lines WHERE source NOT IN {_SRC_IN} AND line <> ''),
looked AS (
  SELECT r.source_sentence, m.target_sentence, m.target_sentence IS NOT NULL AS hit
  FROM req r LEFT JOIN (SELECT * FROM mem WHERE target_sentence IS NOT NULL AND target_sentence <> '') m
    ON 'hi_' || sha256(r.source_sentence) = m.key)"""


@register("memory_lookup", _with(o.DOC_LINES, _MEM_SQL) + "SELECT * FROM looked")
def q_memory_lookup(spark, sf_dir):
    return mem.memory_lookup(_requests(spark, sf_dir), _memory(spark, sf_dir), "hi")


@register("memory_misses", _with(o.DOC_LINES, _MEM_SQL) + "SELECT source_sentence FROM looked WHERE NOT hit")
def q_memory_misses(spark, sf_dir):
    return mem.memory_misses(_requests(spark, sf_dir), _memory(spark, sf_dir), "hi")


@register(
    "memory_upsert",
    _with(o.DOC_LINES, _MEM_SQL) + """
, new AS (SELECT 'hi_' || sha256(source_sentence) AS key, source_sentence, '[hi] ' || source_sentence AS target_sentence,
                 'und' AS source_language, 'hi' AS target_language FROM looked WHERE NOT hit)
SELECT key, source_sentence, target_sentence, source_language, target_language FROM mem
WHERE key NOT IN (SELECT key FROM new)
UNION ALL SELECT * FROM new""",
)
def q_memory_upsert(spark, sf_dir):
    memory = _memory(spark, sf_dir)
    misses = mem.memory_misses(_requests(spark, sf_dir), memory, "hi")
    # The translation step is an input table; here: a tagged copy of the source.
    new = mem.memory_rows(misses, _translate("source_sentence"), F.lit("und"), F.lit("hi"), text_col="source_sentence")
    return mem.memory_upsert(memory, new)


# ------------------------------------------------------------ keyed merge ----
_CUST_FIELDS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _people(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.struct(F.col("c_custkey").cast("string").alias("oid")).alias("_id"), *_CUST_FIELDS)


def _people_updates(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    upd = c.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.struct(F.col("c_custkey").cast("string").alias("oid")).alias("_id"),
        F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("int").alias("c_nationkey"),
        F.lit(None).cast("double").alias("c_acctbal"), F.lit("BUILDING_UPDATED").alias("c_mktsegment"),
    )
    new = c.filter(F.col("c_nationkey") == 0).select(
        F.struct((F.col("c_custkey") + 1000000).cast("string").alias("oid")).alias("_id"), *_CUST_FIELDS
    )
    return upd.unionByName(new)


@register(
    "keyed_merge",
    """WITH b AS (SELECT c_custkey::VARCHAR AS oid, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
u AS (SELECT c_custkey::VARCHAR AS oid, NULL::VARCHAR AS c_name, NULL::INTEGER AS c_nationkey, NULL::DOUBLE AS c_acctbal,
             'BUILDING_UPDATED' AS c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
      UNION ALL
      SELECT (c_custkey + 1000000)::VARCHAR, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey = 0)
SELECT coalesce(b.oid, u.oid) AS oid, coalesce(u.c_name, b.c_name) AS c_name,
       coalesce(u.c_nationkey, b.c_nationkey) AS c_nationkey, coalesce(u.c_acctbal, b.c_acctbal) AS c_acctbal,
       coalesce(u.c_mktsegment, b.c_mktsegment) AS c_mktsegment
FROM b FULL OUTER JOIN u ON b.oid = u.oid""",
)
def q_keyed_merge(spark, sf_dir):
    return mem.keyed_merge(_people(spark, sf_dir), _people_updates(spark, sf_dir), "_id.oid", _CUST_FIELDS)


_CUST_COLS = "c_custkey, c_name, c_nationkey, c_acctbal"
_FIRST_AUTO = "(SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"


@register(
    "predicate_update",
    f"""SELECT {_CUST_COLS}, CASE WHEN coalesce(c_custkey = {_FIRST_AUTO}, false) THEN 'MACHINERY' ELSE c_mktsegment END
       AS c_mktsegment FROM customer""",
)
def q_predicate_update(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return mem.predicate_update(c, F.col("c_mktsegment") == "AUTOMOBILE", "c_mktsegment", "MACHINERY", "c_custkey")


@register("predicate_delete", f"SELECT * FROM customer WHERE NOT coalesce(c_custkey = {_FIRST_AUTO}, false)")
def q_predicate_delete(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return mem.predicate_delete(c, F.col("c_mktsegment") == "AUTOMOBILE", "c_custkey")


@register("predicate_find", "SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 7")
def q_predicate_find(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return mem.predicate_find(c, (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_nationkey") == 7))


# ---------------------------------------------------------------- layout ----
from sentforge.functions import text as T  # noqa: E402
from sentforge.functions.text import STYLE_RULE_ESCAPED  # noqa: E402
from sentforge.operators import layout as lay  # noqa: E402
from sentforge.operators.intervals import all_covering  # noqa: E402

# Test binding of the layout inputs: a line table derived from document lines,
# line boxes derived from lineitem (file = order key mod 1000, so a file holds
# a few boxes per page and footer groups occur), one to three table cells on
# every page.
LINES_PER_PAGE = 8


def layout_lines(spark, sf_dir):
    d = doc_lines(spark, sf_dir)
    idx = (F.col("line_no") % LINES_PER_PAGE).cast("int")
    top = (F.lit(50) + F.lit(165) * idx).cast("int")
    left = (F.lit(100) + F.lit(20) * (F.length("line") % 3)).cast("int")
    return d.select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("filename"),
        (F.floor(F.col("line_no") / LINES_PER_PAGE) + 1).cast("int").alias("page_no"),
        idx.alias("idx"),
        F.when(F.length("line") % 5 == 0, "18Times#000").otherwise("12Times#000").alias("style_key"),
        F.concat(F.lit("top:"), top.cast("string"), F.lit("px;left:"), left.cast("string"), F.lit("px;")).alias("inline_style"),
        F.col("line").alias("text"),
        top.alias("top"),
    )


def line_boxes(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("doc"), (F.col("l_orderkey") % 1000).cast("string")).alias("file_id"),
        F.col("l_linenumber").cast("int").alias("page_num"),
        (F.lit(50) * (F.col("l_partkey") % 5)).cast("int").alias("x"),
        (F.col("l_quantity") * 25).cast("int").alias("y"),
        (F.lit(40) + F.lit(20) * (F.col("l_suppkey") % 3)).cast("int").alias("w"),
    )


def table_cell_boxes(spark, sf_dir, lines=None):
    """One to three cells on every page, at heights that vary with the page."""
    lines = lines if lines is not None else layout_lines(spark, sf_dir)
    pages = lines.select("filename", "page_no").distinct()
    cells = pages.select("*", F.explode(F.sequence(F.lit(0), F.col("page_no") % 3)).alias("row"))
    return cells.select(
        F.col("filename").alias("file_id"), F.col("page_no").alias("page_num"), "row", F.lit(0).alias("col"), F.lit(100).alias("x"),
        (150 + 260 * F.col("row") + 70 * (F.col("page_no") % 4)).cast("int").alias("y"), F.lit(600).alias("w"), (120 + 90 * F.col("row")).cast("int").alias("h"))


_LAYOUT_SQL = """layout AS (
  SELECT 'doc' || doc_id::VARCHAR AS filename, (line_no // 8 + 1)::INTEGER AS page_no, (line_no % 8)::INTEGER AS idx,
         CASE WHEN length(line) % 5 = 0 THEN '18Times#000' ELSE '12Times#000' END AS style_key,
         line AS text, (50 + 165 * (line_no % 8))::INTEGER AS top
  FROM doc_lines),
boxes AS (
  SELECT 'doc' || (l_orderkey % 1000)::VARCHAR AS file_id, l_linenumber::INTEGER AS page_num,
         (50 * (l_partkey % 5))::INTEGER AS x, (l_quantity * 25)::INTEGER AS y, (40 + 20 * (l_suppkey % 3))::INTEGER AS w FROM lineitem),
cells AS (
  SELECT filename AS file_id, page_no AS page_num, row::INTEGER AS row, 0 AS col, 100 AS x, (150 + 260 * row + 70 * (page_no % 4))::INTEGER AS y,
         600 AS w, (120 + 90 * row)::INTEGER AS h
  FROM (SELECT filename, page_no, unnest(range(page_no % 3 + 1)) AS row FROM (SELECT DISTINCT filename, page_no FROM layout)))"""

_L = _with(o.DOC_LINES, _LAYOUT_SQL)


_HTML_SQL = f"""WITH pg AS (
  SELECT page_id,
         string_split_regex(trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)), '\\s+')[2] AS page_no,
         array_to_string(regexp_extract_all(html, '(?is)<style[^>]*>(.*?)</style>', 1), ' ') AS style_text,
         regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>|<!--.*?-->', '', 'g') AS body
  FROM pages),
rules AS (
  SELECT page_id, pos, regexp_extract(e, {o.q('(?i)' + STYLE_RULE_ESCAPED)}, 1) AS k,
         regexp_extract(e, {o.q('(?i)' + STYLE_RULE_ESCAPED)}, 3) || regexp_extract(e, {o.q('(?i)' + STYLE_RULE_ESCAPED)}, 5)
           || regexp_extract(e, {o.q('(?i)' + STYLE_RULE_ESCAPED)}, 7) AS v
  FROM (SELECT page_id, unnest(string_split_regex(style_text, '\\s+')) AS e,
               generate_subscripts(string_split_regex(style_text, '\\s+'), 1) AS pos FROM pg)
  WHERE regexp_matches(e, {o.q('(?i)' + STYLE_RULE_ESCAPED)})),
cut AS (
  SELECT page_id, page_no, string_split(regexp_replace(regexp_replace(body, '(?i)</p\\s*>|</body', chr(1) || '\\0', 'g'),
           '(?i)<p([\\s>])', chr(2) || '<p\\1', 'g'), chr(2)) AS parts
  FROM pg),
ps AS (
  SELECT page_id, page_no, unnest(list_transform(parts[2:], lambda x: string_split(x, chr(1))[1] || '</p>')) AS p0,
         (generate_subscripts(parts[2:], 1) - 1)::INTEGER AS idx
  FROM cut),
pc AS (
  SELECT page_id, page_no, idx,
         trim(regexp_replace(regexp_replace(p0, '<br/>|<i>|<i/>|</i>|<b>|</b>|<b/>', '', 'g'), '\\s+', ' ', 'g')) AS p
  FROM ps),
pl AS (
  SELECT page_id, page_no, idx, regexp_extract(p, '(?i)^<p[^>]*\\bclass="([^"]*)"', 1) AS css_class,
         regexp_extract(p, '(?i)^<p[^>]*\\bstyle="([^"]*)"', 1) AS inline_style,
         regexp_extract(p, '(?is)^<p[^>]*>(.*)</p>$', 1) AS text
  FROM pc)
SELECT pl.page_id, pl.page_no, pl.idx, pl.css_class,
       (SELECT v FROM rules r WHERE r.page_id = pl.page_id AND r.k = pl.css_class ORDER BY pos DESC LIMIT 1) AS style_key,
       pl.inline_style, pl.text
FROM pl"""


@register("html_lines", _HTML_SQL)
def q_html_lines(spark, sf_dir):
    return lay.html_lines(table(spark, sf_dir, "pages"))


@register("agg_group_count", _L + "SELECT filename, style_key, count(*)::BIGINT AS cnt FROM layout GROUP BY ALL")
def q_style_counts(spark, sf_dir):
    return lay.style_counts(layout_lines(spark, sf_dir))


@register(
    "dominant_style",
    _L + """, c AS (SELECT filename, style_key, count(*) AS cnt FROM layout GROUP BY ALL)
SELECT filename, style_key AS para_style_key FROM c
QUALIFY row_number() OVER (PARTITION BY filename ORDER BY cnt DESC, style_key ASC NULLS LAST) = 1""",
)
def q_dominant_style(spark, sf_dir):
    return lay.dominant_style(layout_lines(spark, sf_dir))


@register(
    "window_rank_top1",
    _L + """, c AS (SELECT filename, style_key, count(*) AS cnt FROM layout GROUP BY ALL)
SELECT filename, style_key AS para_style_key FROM c QUALIFY rank() OVER (PARTITION BY filename ORDER BY cnt DESC) = 1""",
)
def q_rank_top1(spark, sf_dir):
    return lay.dominant_style(layout_lines(spark, sf_dir), keep_ties=True)


_FOOTER_BOXES_SQL = """fb AS (
  SELECT file_id, page_num, x, w, count(*)::BIGINT AS cnt, min(y) AS min_y, max(y) AS max_y
  FROM boxes WHERE w > 50 GROUP BY file_id, page_num, x, w
  HAVING min(y) > 1000 AND (count(*) = 1 OR max(y) - min(y) > 150))"""


@register("agg_having", _L + ", " + _FOOTER_BOXES_SQL + " SELECT * FROM fb")
def q_footer_boxes(spark, sf_dir):
    return lay.footer_boxes(line_boxes(spark, sf_dir))


@register("footer_lines", _L + ", " + _FOOTER_BOXES_SQL + " SELECT file_id, page_num, min(min_y) AS footer_y FROM fb GROUP BY ALL")
def q_footer_lines(spark, sf_dir):
    return lay.footer_lines(line_boxes(spark, sf_dir))


@register(
    "table_cells",
    _L + """, m AS (
  SELECT l.filename, l.page_no, l.idx, l.top, c.row AS cell_row, c.y AS cell_y,
         row_number() OVER (PARTITION BY l.filename, l.page_no, l.idx ORDER BY c.y NULLS LAST, c.row NULLS LAST, c.col NULLS LAST) AS rn
  FROM layout l LEFT JOIN cells c ON l.filename = c.file_id AND l.page_no = c.page_num AND l.top >= c.y AND l.top <= c.y + c.h)
SELECT filename, page_no, idx, top, cell_row, cell_y FROM m WHERE rn = 1""",
)
def q_table_cells(spark, sf_dir):
    out = lay.line_cells(layout_lines(spark, sf_dir), table_cell_boxes(spark, sf_dir))
    return out.select("filename", "page_no", "idx", "top", "cell_row", "cell_y")


@register("join_range_containment", _L + """SELECT l.filename, l.page_no, l.idx, l.top, c.row AS cell_row, c.y AS cell_y, c.h AS cell_h
FROM layout l JOIN cells c ON l.filename = c.file_id AND l.page_no = c.page_num AND l.top BETWEEN c.y - 100 AND c.y + c.h + 100""")
def q_range_containment(spark, sf_dir):
    """Every line with every cell that it touches within a margin."""
    lines = layout_lines(spark, sf_dir)
    out = all_covering(lines, table_cell_boxes(spark, sf_dir, lines), [("filename", "file_id"), ("page_no", "page_num")], "top",
                       F.col("y") - 100, F.col("y") + F.col("h") + 100, ["row", "y", "h"], name="cell")
    return out.select("filename", "page_no", "idx", "top", F.col("cell.row").alias("cell_row"), F.col("cell.y").alias("cell_y"), F.col("cell.h").alias("cell_h"))


@register(
    "window_neighbors",
    _L + """, d AS (SELECT filename, style_key AS para_style_key FROM
   (SELECT filename, style_key, count(*) AS cnt FROM layout GROUP BY ALL)
   QUALIFY row_number() OVER (PARTITION BY filename ORDER BY cnt DESC, style_key ASC NULLS LAST) = 1)
SELECT l.filename, l.page_no, l.idx,
       count(*) OVER p AS n_lines,
       max(CASE WHEN l.style_key = d.para_style_key AND trim(l.text) <> '' THEN l.idx END) OVER p AS last_para_idx,
       lag(l.style_key) OVER w AS prev_style, lead(l.style_key) OVER w AS next_style,
       lag(l.top) OVER w AS prev_top, lead(l.top) OVER w AS next_top
FROM layout l LEFT JOIN d USING (filename)
WINDOW p AS (PARTITION BY l.filename, l.page_no), w AS (PARTITION BY l.filename, l.page_no ORDER BY l.idx)""",
)
def q_window_neighbors(spark, sf_dir):
    lines = layout_lines(spark, sf_dir)
    f = lay.line_features(lines, lay.dominant_style(lines), None, None)
    return f.select("filename", "page_no", "idx", "n_lines", "last_para_idx", "prev_style", "next_style",
                    "prev_top", "next_top")


def _paragraphs(spark, sf_dir, strict=False):
    lines = layout_lines(spark, sf_dir)
    return lay.paragraphs(lines, line_boxes(spark, sf_dir), table_cell_boxes(spark, sf_dir, lines), strict=strict)


_SENT_END = f"""coalesce(regexp_matches(line, {o.q('(?i)' + T.END_OF_SENTENCE)}) AND NOT ({" OR ".join(
    f"right(line, {n}) IN ({', '.join(o.q(x) for x in lst)})"
    for n, lst in ((4, T.ABBREVIATIONS_4), (5, T.ABBREVIATIONS_5), (6, T.ABBREVIATIONS_6), (7, T.ABBREVIATIONS_7)))}), false)"""

# The paragraph rule line by line: a recursive query carries the open block, its
# style and trailing blank, and whether a text block ended above.
_PARAGRAPH_SQL = f"""WITH RECURSIVE {o.DOC_LINES}, {_LAYOUT_SQL}, {_FOOTER_BOXES_SQL},
foot AS (SELECT file_id, page_num, min(min_y) AS footer_y FROM fb GROUP BY ALL),
dom AS (SELECT filename, style_key AS para FROM (SELECT filename, style_key, count(*) AS cnt FROM layout GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY filename ORDER BY cnt DESC, style_key ASC NULLS LAST) = 1),
cell AS (SELECT l.filename, l.page_no, l.idx, c.x AS cx, c.y AS cy FROM layout l
  JOIN cells c ON l.filename = c.file_id AND l.page_no = c.page_num AND l.top >= c.y AND l.top <= c.y + c.h
  QUALIFY row_number() OVER (PARTITION BY l.filename, l.page_no, l.idx ORDER BY c.y, c.row, c.col) = 1),
f AS (SELECT l.filename, l.page_no, l.idx, l.style_key AS sk, d.para, l.top, l.text AS line, coalesce(b.footer_y, -1) AS fy, cell.cx, cell.cy,
    'top:' || l.top || 'px;left:' || (100 + 20 * (length(l.text) % 3)) || 'px;' AS style,
    row_number() OVER w - 1 AS i, count(*) OVER p AS n, lead(l.style_key) OVER w AS nx, lag(l.top) OVER w AS pt, lead(l.top) OVER w AS nt,
    max(CASE WHEN l.style_key = d.para AND trim(l.text) <> '' THEN l.idx END) OVER p AS last_para
  FROM layout l LEFT JOIN dom d USING (filename) LEFT JOIN foot b ON b.file_id = l.filename AND b.page_num = l.page_no
  LEFT JOIN cell USING (filename, page_no, idx)
  WINDOW p AS (PARTITION BY l.filename, l.page_no), w AS (PARTITION BY l.filename, l.page_no ORDER BY l.idx)),
k AS (SELECT *, {_SENT_END} AS se, i = n - 1 AS last,
    CASE WHEN (i <= 3 OR n - i <= 3) AND (top < 75 OR top > 1175) THEN 'band' WHEN fy > 0 AND top > fy THEN 'foot'
         WHEN cy IS NOT NULL THEN 'cell' WHEN sk = para THEN 'body' ELSE 'plain' END AS kind FROM f),
g AS (SELECT *, CASE WHEN kind = 'band' THEN regexp_matches(line, {o.q('^' + T.PAGE_NUMBER_FORMAT)}) OR trim(line) IN (page_no::VARCHAR, '')
         WHEN kind = 'foot' AND last THEN trim(line) = page_no::VARCHAR ELSE false END AS num FROM k),
h AS (SELECT *, CASE WHEN num THEN '' ELSE line END AS text,
    row_number() OVER (PARTITION BY filename, page_no ORDER BY idx) AS r, count(*) OVER (PARTITION BY filename, page_no) AS m
  FROM g WHERE NOT (num AND kind = 'band')),
st AS (
  SELECT filename, page_no, 0::BIGINT AS r, CAST([] AS VARCHAR[]) AS buf, '' AS tail, '' AS style, false AS ended, true AS closed, '' AS kind,
    NULL::INTEGER AS cx, NULL::INTEGER AS cy, CAST([] AS STRUCT(t VARCHAR, s VARCHAR, y INTEGER, p VARCHAR)[]) AS said FROM h WHERE r = 1
  UNION ALL
  SELECT filename, page_no, r, buf, tail, style, ended OR (closes AND kind IN ('plain', 'body') AND len(buf) > 0), closes, kind, cx, cy,
    said || CASE WHEN closes AND len(buf) > 0 THEN [{{'t': array_to_string(buf, ' ') || tail, 's': style, 'y': top, 'p': lab}}]
                 WHEN NOT closes AND r = m AND len(buf) > 0 THEN [{{'t': array_to_string(buf, ' ') || tail, 's': style, 'y': top, 'p': 'end_incomplete'}}]
                 ELSE [] END
  FROM (SELECT *, CASE WHEN trim(text) <> '' THEN CASE WHEN kind = 'cell' OR (kind = 'foot' AND NOT last) OR (kind = 'body' AND NOT closes)
          OR (kind = 'plain' AND NOT fresh) THEN ' ' ELSE '' END WHEN fresh THEN '' ELSE otail END AS tail FROM (
    SELECT h.filename, h.page_no, h.r, h.m, h.text, h.last, h.top, h.kind, h.cx, h.cy, s.ended, s.tail AS otail, z.fresh,
      CASE WHEN z.fresh THEN h.style ELSE s.style END AS style,
      CASE WHEN z.fresh THEN [] ELSE s.buf END || CASE WHEN trim(h.text) <> '' THEN [h.text] ELSE [] END AS buf,
      s.said || CASE WHEN z.opens AND NOT s.closed AND len(s.buf) > 0
                     THEN [{{'t': array_to_string(s.buf, ' ') || s.tail, 's': s.style, 'y': h.top, 'p': z.lab}}] ELSE [] END AS said,
      z.lab, z.closes
    FROM st s JOIN h ON h.filename = s.filename AND h.page_no = s.page_no AND h.r = s.r + 1, LATERAL (SELECT o1.*, s.closed OR o1.opens AS fresh FROM (SELECT
      CASE WHEN h.kind = 'cell' THEN s.kind <> 'cell' OR s.cx <> h.cx OR s.cy <> h.cy ELSE h.kind IN ('plain', 'body') AND s.kind = 'cell' END AS opens,
      CASE WHEN h.top < 75 THEN 'header' WHEN NOT s.ended THEN 'start' WHEN h.idx = h.last_para THEN CASE WHEN h.se THEN 'end_complete' ELSE 'end_incomplete' END
           WHEN h.top > 1175 OR (h.fy > 0 AND h.top > h.fy) THEN 'footer' WHEN h.cy IS NOT NULL THEN 'table' ELSE 'regular' END AS lab,
      CASE h.kind WHEN 'band' THEN true WHEN 'foot' THEN h.last
           WHEN 'body' THEN h.se OR (h.idx = h.last_para AND h.top >= 75 AND s.ended)
           WHEN 'plain' THEN NOT (NOT h.last AND coalesce(h.pt = h.nt, false)) AND NOT (h.se AND coalesce(h.sk = h.nx, false))
                AND (h.se OR coalesce(h.nx = h.para, false)) ELSE false END AS closes) o1) z))
),
paras AS (SELECT filename, page_no, unnest(said) AS e, (generate_subscripts(said, 1) - 1)::INTEGER AS para_no
  FROM st JOIN (SELECT filename, page_no, max(m) AS m FROM h GROUP BY ALL) q USING (filename, page_no) WHERE st.r = q.m),
out AS (SELECT filename, page_no, para_no, e.t AS para_text, e.s AS para_style, page_no AS page_num, e.y AS y_end, e.p AS para_position FROM paras)
"""
_XY = "regexp_extract(para_style, 'left:([0-9]+)px', 1)::INTEGER AS x, regexp_extract(para_style, 'top:([0-9]+)px', 1)::INTEGER AS y"
_STITCH_SQL = _PARAGRAPH_SQL + f""", q AS (SELECT *, {_XY} FROM out),
s AS (SELECT * FROM q WHERE para_position = 'start'), e AS (SELECT * FROM q WHERE para_position = 'end_incomplete')
SELECT filename, page_no, para_text, para_style, page_num, y_end, para_position, x, y FROM q WHERE para_position NOT IN ('start', 'end_incomplete')
UNION ALL SELECT e.filename, e.page_no, e.para_text || ' ' || s.para_text, e.para_style, e.page_no, s.y_end, e.para_position, s.x, s.y
  FROM s JOIN e ON s.filename = e.filename AND s.page_no = e.page_no + 1
UNION ALL SELECT filename, page_no, para_text, para_style, page_num, y_end, para_position, x, y FROM s
  WHERE NOT EXISTS (FROM e WHERE s.filename = e.filename AND s.page_no = e.page_no + 1)
UNION ALL SELECT filename, page_no, para_text, para_style, page_num, y_end, para_position, x, y FROM e
  WHERE NOT EXISTS (FROM s WHERE s.filename = e.filename AND s.page_no = e.page_no + 1)"""


@register("paragraph_assemble", _PARAGRAPH_SQL + "SELECT * FROM out")
def q_paragraph_assemble(spark, sf_dir):
    return _paragraphs(spark, sf_dir)


@register("line_position", _PARAGRAPH_SQL + "SELECT para_position, count(*)::BIGINT AS n FROM out GROUP BY ALL")
def q_line_position(spark, sf_dir):
    return _paragraphs(spark, sf_dir).groupBy("para_position").agg(F.count(F.lit(1)).alias("n"))


@register("paragraph_stitch", _STITCH_SQL)
def q_paragraph_stitch(spark, sf_dir):
    return lay.paragraph_stitch(_paragraphs(spark, sf_dir))
