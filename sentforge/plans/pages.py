"""The page job end to end: HTML pages -> lines -> paragraphs -> paragraphs joined across pages.

The pages are made from the documents: eight lines a page, every line a ``<p>``
with its place and the class of its font, a page number below, and a file name
that ends in the page's number.  The oracle never sees HTML; it reads the same
lines from the documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sentforge.functions import text as T
from sentforge.functions.nested import flatten_blocks
from sentforge.operators import layout as lay
from sentforge.plans import oracle_sql as o
from sentforge.plans import registry as R
from sentforge.plans.registry import register
from sentforge.session import staged

CLASSES = {"12Times#000": "ft0", "18Times#000": "ft1"}
_RULES = " ".join(f".{c}{{font-size:{k[:2]}px;font-family:Times;color:#000;}}" for k, c in CLASSES.items())
NUMBER_TOP = 1215


def _page_lines(spark, sf_dir):
    """Layout lines without angle brackets and outer blanks, and a page number line on every page."""
    d = R.layout_lines(spark, sf_dir)
    line = F.trim(F.regexp_replace(F.translate("text", "<>", "  "), r"\s+", " "))
    left = lambda text: (F.lit(100) + F.lit(20) * (F.length(text) % 3)).cast("int").cast("string")
    style = lambda top, text: F.concat(F.lit("top:"), top.cast("string"), F.lit("px;left:"), left(text), F.lit("px;"))
    lines = d.select("filename", "page_no", "idx", line.alias("text"), "top")
    lines = lines.withColumn("style_key", F.when(F.length("text") % 5 == 0, "18Times#000").otherwise("12Times#000"))
    pages = lines.groupBy("filename").agg(F.max("page_no").alias("n")).select("filename", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("page_no"))
    number = F.concat(F.lit("Page "), F.col("page_no").cast("string"), F.lit(" of "), F.col("n").cast("string"))
    numbers = pages.select("filename", "page_no", F.lit(R.LINES_PER_PAGE).alias("idx"), number.alias("text"), F.lit(NUMBER_TOP).alias("top"),
                           F.lit("18Times#000").alias("style_key"))
    rows = lines.unionByName(numbers)
    return rows.withColumn("inline_style", style(F.col("top"), F.col("text")))


def converted_pages(spark, sf_dir):
    """``filepath`` and ``html`` of every page."""
    rows = _page_lines(spark, sf_dir)
    css = F.when(F.col("style_key") == "18Times#000", "ft1").otherwise("ft0")
    p = F.concat(F.lit('<p style="'), F.col("inline_style"), F.lit('" class="'), css, F.lit('">'), F.col("text"), F.lit("</p>"))
    pages = rows.groupBy("filename", "page_no").agg(F.array_sort(F.collect_list(F.struct("idx", p.alias("p")))).alias("ps"))  # nine lines a page
    number = F.col("page_no").cast("string")
    html = F.concat(F.lit("<!DOCTYPE html><html><head><title>Page "), number, F.lit(f"</title><style type=\"text/css\">\n{_RULES}\n</style></head><body>"),
                    F.array_join(F.transform("ps", lambda x: x["p"]), "\n"), F.lit("</body></html>"))
    return pages.select(F.concat(F.lit("/pages/"), F.col("filename"), F.lit("--"), number, F.lit(".html")).alias("filepath"), html.alias("html"))


def _html(spark, sf_dir):
    return lay.html_lines(converted_pages(spark, sf_dir), "filepath")


_CLEAN_LINES = o.DOC_LINES.replace("doc_lines AS", "raw_lines AS", 1) + """,
doc_lines AS (SELECT doc_id, lang, source, line_no, trim(regexp_replace(replace(replace(line, '<', ' '), '>', ' '), '\\s+', ' ', 'g')) AS line FROM raw_lines)"""
_NUMBERED = R._LAYOUT_SQL.replace("layout AS (", "text_layout AS (", 1).replace("boxes AS (", f"""layout AS (
  SELECT * FROM text_layout UNION ALL
  SELECT filename, page_no, lines::INTEGER, '18Times#000', 'Page ' || page_no || ' of ' || max(page_no) OVER (PARTITION BY filename), {NUMBER_TOP}
  FROM (SELECT filename, page_no, count(*) AS lines FROM text_layout GROUP BY ALL)),
boxes AS (""", 1)
_PAGES = "WITH " + _CLEAN_LINES + ", " + _NUMBERED


def _on_pages(sql: str) -> str:
    """A layout oracle over the pages' lines."""
    return sql.replace(o.DOC_LINES, _CLEAN_LINES).replace(R._LAYOUT_SQL, _NUMBERED)


def _sides(spark, sf_dir):
    """Line boxes and table cells of the pages."""
    return R.line_boxes(spark, sf_dir), R.table_cell_boxes(spark, sf_dir)


@register("page_paragraphs", _on_pages(R._PARAGRAPH_SQL) + "SELECT * FROM out")
def q_page_paragraphs(spark, sf_dir):
    lines = staged(lay.line_table(_html(spark, sf_dir)), "page-lines")  # read for styles and for lines, parsed once
    return lay.paragraphs(lines, *_sides(spark, sf_dir))


@register("page_job", _on_pages(R._STITCH_SQL))
def q_page_job(spark, sf_dir):
    return lay.page_job(converted_pages(spark, sf_dir), *_sides(spark, sf_dir))


@register("fn_map_lookup", _PAGES + """SELECT '/pages/' || filename || '--' || page_no || '.html' AS filepath, idx,
  CASE style_key WHEN '18Times#000' THEN 'ft1' ELSE 'ft0' END AS css_class, style_key FROM layout""")
def q_map_lookup(spark, sf_dir):
    """Each line's class looked up in the rules of its page."""
    return _html(spark, sf_dir).select("filepath", "idx", "css_class", "style_key")


@register("fn_page_number_text", _PAGES + f"""SELECT filename, page_no, idx,
  regexp_matches(text, {o.q('^' + T.PAGE_NUMBER_FORMAT)}) OR trim(text) IN (page_no::VARCHAR, '') AS is_page_no FROM layout""")
def q_page_number_text(spark, sf_dir):
    lines = lay.line_table(_html(spark, sf_dir))
    return lines.select("filename", "page_no", "idx", T.is_page_number_text("text", F.col("page_no")).alias("is_page_no"))


@register("udf_filename", _PAGES + "SELECT DISTINCT '/pages/' || filename || '--' || page_no || '.html' AS filepath, filename AS html_base FROM layout")
def q_filename(spark, sf_dir):
    return converted_pages(spark, sf_dir).select("filepath", T.html_page_basename("filepath").alias("html_base"))


# ---------------------------------------------------------------- JSON ----
@register("fn_from_json", """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE try_cast(json_extract_string(props, '$.k') AS BIGINT) END AS k,
  event_id % 7 = 0 AS broken FROM events""")
def q_from_json(spark, sf_dir):
    """Properties parsed by a schema; every seventh text lacks its last character and does not parse."""
    e = R.table(spark, sf_dir, "events")
    cut = F.when(F.col("event_id") % 7 == 0, F.expr("substring(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    parsed = F.from_json(cut, "k bigint, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = e.select("event_id", parsed.alias("j"))
    return rows.select("event_id", "j.k", F.col("j._corrupt").isNotNull().alias("broken"))


@register("flatten_blocks", """WITH t AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations)
SELECT conv_id, unnest(string_split(text, chr(10))) AS text FROM t UNION ALL SELECT conv_id, 'turn ' || turn FROM t""")
def q_flatten_blocks(spark, sf_dir):
    """Responses of two results: a block per line, and one block that names the turn; a third result is null."""
    c = R.table(spark, sf_dir, "conversations")
    block = lambda x: F.struct(x.alias("text"))
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), block)
    name = F.array(block(F.concat(F.lit("turn "), F.col("turn").cast("string"))))
    results = F.array(F.struct(lines.alias("text_blocks")), F.struct(name.alias("text_blocks")), F.lit(None).cast("struct<text_blocks: array<struct<text: string>>>"))
    return flatten_blocks(c.select("conv_id", results.alias("result")), ["conv_id"])
