"""Queries for the primitive operator ids (filters, projections, joins,
aggregates, windows, scalar / JSON / array functions, nested flattening, ML
text features, SQL surface).  Each reads the test tables and has a DuckDB
oracle; ids whose natural test is a composite query are aliases of it.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sentforge.functions import text as T
from sentforge.functions.nested import flatten_three_level, flatten_two_level
from sentforge.operators import layout as lay
from sentforge.operators import match as mt
from sentforge.operators import tokens as tok
from sentforge.plans import oracle_sql as o
from sentforge.plans import registry as R
from sentforge.plans.registry import QUERIES, _with, register
from sentforge.plans.tables import doc_lines, table
from sentforge.sources.readers import register_parquet_view
from sentforge.sources.sinks import preview

NF = o.normal_form


def _lines_sql() -> str:
    return _with(o.DOC_LINES)


# ------------------------------------------------------------- sources ----
@register("scan_numbered_lines", _lines_sql() + "SELECT doc_id, line_no, line FROM doc_lines")
def q_scan_numbered_lines(spark, sf_dir):
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", "line")


@register("source_file_column", "SELECT 'documents.parquet' AS file_name, count(*)::BIGINT AS n FROM documents")
def q_source_file_column(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(T.file_name(F.col("_metadata.file_path")).alias("file_name"))
    return d.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))


@register(
    "scan_catalog_table",
    "SELECT c_name, c_mktsegment, c_acctbal FROM customer",
)
def q_scan_catalog_table(spark, sf_dir):
    register_parquet_view(spark, "customer_tbl", f"{sf_dir}/customer.parquet")
    return spark.sql(
        "SELECT c_name, c_mktsegment, c_acctbal FROM customer_tbl"
    )


@register(
    "sql_query",
    _lines_sql() + "SELECT lang, count(*)::BIGINT AS n_lines, sum(length(line))::BIGINT AS n_chars FROM doc_lines GROUP BY lang",
)
def q_sql_query(spark, sf_dir):
    lines = doc_lines(spark, sf_dir)
    return spark.sql(
        "SELECT lang, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM {lines} GROUP BY lang",
        lines=lines,
    )


@register(
    "temp_view",
    _lines_sql() + "SELECT source, count(DISTINCT doc_id)::BIGINT AS n_docs FROM doc_lines GROUP BY source",
)
def q_temp_view(spark, sf_dir):
    doc_lines(spark, sf_dir).createOrReplaceTempView("doc_lines_view")
    return spark.sql("SELECT source, count(DISTINCT doc_id) AS n_docs FROM doc_lines_view GROUP BY source")


# --------------------------------------------------------------- sinks ----
@register("console_preview", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 10")
def q_console_preview(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return preview(d, 10, ["doc_id"])


# ------------------------------------------------ projections / filters ----
@register("project", "SELECT doc_id, lang AS language, n_chars FROM documents")
def q_project(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.col("lang").alias("language"), "n_chars", "source").drop("source")


@register("project_star", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_project_star(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("*").where(F.col("c_mktsegment") == "BUILDING")


@register("add_column", "SELECT doc_id, n_chars, n_chars > 1000 AS is_long, right(text, 1) AS last_char FROM documents")
def q_add_column(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.withColumns({"is_long": F.col("n_chars") > 1000, "last_char": F.right("text", F.lit(1))}).select(
        "doc_id", "n_chars", "is_long", "last_char")


@register("project_literal", "SELECT doc_id, ' ' AS sep, 1 AS one FROM documents")
def q_project_literal(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.lit(" ").alias("sep"), F.lit(1).alias("one"))


def _with_nulls(spark, sf_dir):
    """Conversations whose text is NULL on every third turn."""
    c = table(spark, sf_dir, "conversations")
    return c.withColumn("text", F.when(F.col("turn") % 3 != 0, F.col("text")))


@register(
    "null_fill",
    "SELECT conv_id, turn, CASE WHEN turn % 3 <> 0 THEN coalesce(text, '') ELSE '' END AS text, coalesce(role, '') AS role FROM conversations",
)
def q_null_fill(spark, sf_dir):
    return _with_nulls(spark, sf_dir).select("conv_id", "turn", "text", "role").na.fill("")


@register(
    "struct_expand",
    "SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def q_struct_expand(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.*")


@register(
    "filter_regex",
    _lines_sql() + "SELECT doc_id, count(*)::BIGINT AS n FROM doc_lines WHERE regexp_matches(line, '[A-Za-z]') GROUP BY doc_id",
)
def q_filter_regex(spark, sf_dir):
    return doc_lines(spark, sf_dir).filter(T.has_letter("line")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))


@register(
    "filter_or",
    "SELECT conv_id, turn, role FROM conversations WHERE role = 'user' OR role = 'system'",
)
def q_filter_or(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.filter((F.col("role") == "user") | (F.col("role") == "system")).select("conv_id", "turn", "role")


@register("filter_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def q_filter_in(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@register("filter_not_in", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def q_filter_not_in(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.filter(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey", "c_mktsegment")


@register("filter_not_null", "SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL AND turn % 3 <> 0")
def q_filter_not_null(spark, sf_dir):
    return _with_nulls(spark, sf_dir).filter(F.col("text").isNotNull()).select("conv_id", "turn", "text")


@register("filter_nested_field", "SELECT c_custkey::VARCHAR AS oid, c_name FROM customer WHERE c_custkey = 7")
def q_filter_nested_field(spark, sf_dir):
    p = R._people(spark, sf_dir)
    return p.filter(F.col("_id.oid") == "7").select(F.col("_id.oid").alias("oid"), "c_name")


@register("filter_threshold", R._NEAR_SQL.replace("< 0.5", "< 0.3"))
def q_filter_threshold(spark, sf_dir):
    return mt.near_match(*R._near_sides(spark, sf_dir), 0.3)


# ---------------------------------------------------------------- joins ----
@register("join_self_offset", _with(o.DOC_LINES, R._ALIGNED_ALL) + "SELECT * FROM aligned")
def q_join_self_offset(spark, sf_dir):
    return R._aligned_all(spark, sf_dir)


@register(
    "join_lookup_broadcast",
    _with(o.DOC_LINES, R._LAYOUT_SQL) + ", " + R._FOOTER_BOXES_SQL + """
, f AS (SELECT file_id, page_num, min(min_y) AS footer_y FROM fb GROUP BY ALL)
SELECT l.filename, l.page_no, l.idx, coalesce(f.footer_y, -1) AS footer_y
FROM layout l LEFT JOIN f ON l.filename = f.file_id AND l.page_no = f.page_num""",
)
def q_join_lookup_broadcast(spark, sf_dir):
    lines = R.layout_lines(spark, sf_dir)
    f = lay.footer_lines(R.line_boxes(spark, sf_dir)).select(
        F.col("file_id").alias("filename"), F.col("page_num").alias("page_no"), "footer_y")
    # the per-page footer table is small: a broadcast hint is checked by the
    # planner's size estimate, and AQE re-plans from the measured size
    return lines.join(f, ["filename", "page_no"], "left").select(
        "filename", "page_no", "idx", F.coalesce(F.col("footer_y"), F.lit(-1)).alias("footer_y"))


# ----------------------------------------------------------- aggregates ----
@register(
    "agg_count_min_max",
    _with(o.DOC_LINES, R._LAYOUT_SQL) + """
SELECT file_id, page_num, x, w, count(*)::BIGINT AS cnt, min(y) AS min_y, max(y) AS max_y FROM boxes GROUP BY ALL""",
)
def q_agg_count_min_max(spark, sf_dir):
    return R.line_boxes(spark, sf_dir).groupBy("file_id", "page_num", "x", "w").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("y").alias("min_y"), F.max("y").alias("max_y"))


@register(
    "distinct_rows",
    "SELECT DISTINCT unnest(regexp_split_to_array(lower(coalesce(text, '')), '\\s')) AS token FROM documents",
)
def q_distinct_rows(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s")).alias("token")).distinct()


@register(
    "agg_collect_list_by_key",
    _with(o.DOC_LINES, R._LAYOUT_SQL) + """
SELECT file_id, page_num, string_agg(row::VARCHAR || ':' || y::VARCHAR, ',' ORDER BY y, row, col) AS cells
FROM cells GROUP BY file_id, page_num""",
)
def q_collect_list_by_key(spark, sf_dir):
    c = R.table_cell_boxes(spark, sf_dir)
    g = c.groupBy("file_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("y", "row", "col"))).alias("cl"))
    return g.select("file_id", "page_num", F.array_join(F.transform(
        "cl", lambda s: F.concat(s["row"].cast("string"), F.lit(":"), s["y"].cast("string"))), ",").alias("cells"))


@register(
    "file_line_counts",
    _with(*R._SENT_CTES) + """
, src AS (SELECT DISTINCT doc_id, source FROM documents)
SELECT src.source, count(*)::BIGINT AS n_sentences FROM sent JOIN src USING (doc_id) GROUP BY src.source""",
)
def q_file_line_counts(spark, sf_dir):
    s = R._sentences(spark, sf_dir)
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return s.join(d, "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("n_sentences"))


# -------------------------------------------------------- sorts / windows ----
@register(
    "sort_multi_key",
    _with(o.DOC_LINES, R._LAYOUT_SQL) + ", " + R._FOOTER_BOXES_SQL +
    " SELECT file_id, page_num, min_y FROM fb ORDER BY file_id, try_cast(page_num AS INTEGER), min_y",
)
def q_sort_multi_key(spark, sf_dir):
    fb = lay.footer_boxes(R.line_boxes(spark, sf_dir))
    return fb.select("file_id", "page_num", "min_y").orderBy(
        "file_id", F.col("page_num").cast("string").try_cast("int"), "min_y")


@register("token_order", _with(o.negative_tokens_cte()) + "SELECT token FROM neg_tokens ORDER BY length(token), token")
def q_token_order(spark, sf_dir):
    return tok.token_order(R.neg_tokens(spark, sf_dir), ascending=True)


@register(
    "union_all",
    "SELECT text FROM conversations WHERE role = 'user' UNION ALL SELECT text FROM conversations WHERE role <> 'user'",
)
def q_union_all(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.filter(F.col("role") == "user").select("text").union(c.filter(F.col("role") != "user").select("text"))


@register(
    "except_distinct",
    "SELECT role FROM conversations EXCEPT SELECT 'system' AS role",
)
def q_except_distinct(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("role")
    return c.subtract(spark.createDataFrame([("system",)], "role string"))


# ------------------------------------------------------------- functions ----
_ABBR_SQL = " OR ".join(
    f"right(line, {n}) IN ({', '.join(o.q(a) for a in lst)})"
    for n, lst in ((4, T.ABBREVIATIONS_4), (5, T.ABBREVIATIONS_5), (6, T.ABBREVIATIONS_6), (7, T.ABBREVIATIONS_7))
)


@register(
    "fn_text_scalars",
    _lines_sql() + f"""
SELECT doc_id, line_no,
       lower(line) AS lower_line, {NF('line')} AS normal_form,
       len(string_split(line, ' ')) AS word_count, length(line) AS n_chars,
       right(line, 1) AS last_char, substr(line, 1, length(line) - 1) AS drop_last,
       string_split(line, ' ')[2] AS second_word,
       CASE WHEN right(line, 1) = '.' THEN true ELSE false END AS ends_with_period,
       concat(lang, ' ', source) AS lang_source,
       sha256(line) AS line_hash, 'hi_' || sha256(line) AS memory_key,
       trim(regexp_replace(line, '\\s+', ' ', 'g')) AS squeezed,
       trim(replace(replace(replace(line, '"', ''), '“', ''), '”', ''), '''<>() ') AS stripped,
       regexp_extract(line, '([0-9]+)', 1) AS first_number,
       try_cast(regexp_extract(line, '([0-9]+)', 1) AS INTEGER) AS first_number_int
FROM doc_lines""",
)
def q_fn_text_scalars(spark, sf_dir):
    l = doc_lines(spark, sf_dir)
    line = F.col("line")
    return l.select(
        "doc_id", "line_no",
        F.lower(line).alias("lower_line"), T.normal_form(line).alias("normal_form"),
        T.word_count(line).alias("word_count"), F.length(line).cast("bigint").alias("n_chars"),
        F.right(line, F.lit(1)).alias("last_char"), F.expr("substring(line, 1, length(line) - 1)").alias("drop_last"),
        F.get(F.split(line, " "), 1).alias("second_word"),
        F.when(F.right(line, F.lit(1)) == ".", True).otherwise(False).alias("ends_with_period"),
        F.concat("lang", F.lit(" "), "source").alias("lang_source"),
        T.sha256_hex(line).alias("line_hash"), T.memory_key(F.lit("hi"), line).alias("memory_key"),
        T.squeeze_spaces(line).alias("squeezed"), T.strip_chars(line).alias("stripped"),
        F.regexp_extract(line, "([0-9]+)", 1).alias("first_number"),
        F.regexp_extract(line, "([0-9]+)", 1).try_cast("int").alias("first_number_int"),
    )


@register(
    "fn_sentence_end",
    _lines_sql() + f"""
SELECT doc_id, line_no,
       coalesce(regexp_matches(line, {o.q('(?i)' + T.END_OF_SENTENCE)}) AND NOT ({_ABBR_SQL}), false) AS sent_end,
       regexp_matches(line, {o.q('^' + T.PAGE_NUMBER_FORMAT)}) OR trim(line) = '3' OR trim(line) = '' AS is_page_no
FROM doc_lines""",
)
def q_fn_sentence_end(spark, sf_dir):
    l = doc_lines(spark, sf_dir)
    return l.select("doc_id", "line_no", T.sentence_end("line").alias("sent_end"),
                    T.is_page_number_text("line", F.lit("3")).alias("is_page_no"))


_EXTS = ("csv", "txt", "pdf", "docx", "xml")


@register(
    "route_by_extension",
    f"""WITH p AS (SELECT doc_id, '/in/' || doc_id::VARCHAR || '.' || ({', '.join(o.q(e) for e in _EXTS).join(['[', ']'])})[doc_id % 5 + 1] AS path FROM documents)
SELECT doc_id, path, CASE WHEN lower(regexp_extract(path, '\\.([^./]+)$', 1)) IN ('txt', 'pdf', 'docx')
                          THEN lower(regexp_extract(path, '\\.([^./]+)$', 1)) || '_processing'
                          WHEN lower(regexp_extract(path, '\\.([^./]+)$', 1)) = 'csv' THEN 'csv_token_extractor'
                          ELSE 'txt_processing' END AS branch FROM p""",
)
def q_route_by_extension(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    ext = F.element_at(F.array(*[F.lit(e) for e in _EXTS]), (F.col("doc_id") % 5 + 1).cast("int"))
    p = d.select("doc_id", F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit("."), ext).alias("path"))
    return p.select("doc_id", "path", T.route_by_extension("path").alias("branch"))


@register(
    "fn_basename",
    """SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1] AS file_name,
       regexp_extract(regexp_replace(url, '[?#].*$', ''), '(.*/)(.*)(--[0-9]*)(\\.html)', 2) AS html_base
FROM pages""",
)
def q_fn_basename(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    path = F.regexp_replace("url", "[?#].*$", "")
    return p.select("page_id", T.file_name(path).alias("file_name"), T.html_page_basename(path).alias("html_base"))


@register(
    "fn_image_name_parts",
    """WITH p AS (SELECT page_id, '/img/page' || page_id::VARCHAR || '-' || lpad(((page_id % 40) + 1)::VARCHAR, 3, '0')
                        || '.png' AS path FROM pages)
SELECT page_id, path, regexp_extract(path, '(.*)(-)(0*)(.*)(\\.png)', 1) AS file_id,
       regexp_extract(path, '(.*)(-)(0*)(.*)(\\.png)', 4) AS page_num FROM p""",
)
def q_fn_image_name_parts(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    page = F.lpad(((F.col("page_id") % 40) + 1).cast("string"), 3, "0")
    path = F.concat(F.lit("/img/page"), F.col("page_id").cast("string"), F.lit("-"), page, F.lit(".png"))
    x = p.select("page_id", path.alias("path"))
    return x.select("page_id", "path", T.image_name_part("path", 1).alias("file_id"),
                    T.image_name_part("path", 4).alias("page_num"))


@register(
    "fn_arrays_zip",
    _lines_sql() + "SELECT doc_id, line AS l, length(line) AS n FROM doc_lines",
)
def q_fn_arrays_zip(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    z = d.select("doc_id", F.arrays_zip(lines.alias("l"), F.transform(lines, lambda x: F.length(x)).alias("n")).alias("z"))
    return z.select("doc_id", F.inline("z")).select("doc_id", "l", F.col("n").cast("bigint").alias("n"))


@register(
    "fn_parse_array_string",
    "SELECT conv_id, turn, unnest(from_json(to_json(string_split(coalesce(text, ''), chr(10))), '[\"VARCHAR\"]')) AS line "
    "FROM conversations",
)
def q_fn_parse_array_string(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    as_text = F.to_json(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"))
    return c.select("conv_id", "turn", F.explode(F.from_json(as_text, "array<string>")).alias("line"))


# ------------------------------------------------------ nested responses ----
_CONV_LINES = """cl AS (
  SELECT conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM conversations)"""


@register("flatten_two_level", _with(_CONV_LINES) + "SELECT conv_id, line AS sentence FROM cl")
def q_flatten_two_level(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    resp = c.select("conv_id", F.array(F.struct(F.split(F.coalesce("text", F.lit("")), "\n").alias("text"))).alias("data"))
    return flatten_two_level(resp, ["conv_id"]).withColumnRenamed("text", "sentence")


@register("flatten_three_level", _with(_CONV_LINES) + "SELECT conv_id, line AS src FROM cl")
def q_flatten_three_level(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    sents = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.struct(x.alias("src")))
    # every block also carries a NULL sentence, which flattening must skip
    with_null = F.concat(sents, F.array(F.lit(None).cast("struct<src:string>")))
    resp = c.select("conv_id", F.array(F.struct(F.array(F.struct(with_null.alias("tokenized_sentences")))
                                                .alias("text_blocks"))).alias("result"))
    return flatten_three_level(resp, ["conv_id"])


# ------------------------------------------------------ ML text features ----
@register(
    "ml_tokenize",
    "SELECT t AS token, count(*)::BIGINT AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\\s')) AS t "
    "FROM (SELECT regexp_replace(text, '\\s+$', '') AS text FROM benchmark) WHERE text IS NOT NULL) GROUP BY t",
)
def q_ml_tokenize(spark, sf_dir):
    from pyspark.ml.feature import Tokenizer

    b = table(spark, sf_dir, "benchmark").filter(F.col("text").isNotNull())
    t = Tokenizer(inputCol="text", outputCol="tokens").transform(b)
    return t.select(F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"))


@register(
    "ml_ngram",
    """SELECT g AS ngram, count(*)::BIGINT AS n FROM (
  SELECT unnest(list_transform(range(1, length(lower(text))), lambda i: substr(lower(text), i, 1) || ' ' || substr(lower(text), i + 1, 1))) AS g
  FROM benchmark WHERE length(text) >= 2) GROUP BY g""",
)
def q_ml_ngram(spark, sf_dir):
    from pyspark.ml.feature import NGram, RegexTokenizer

    b = table(spark, sf_dir, "benchmark").filter(F.length("text") >= 2)
    t = RegexTokenizer(pattern="", inputCol="text", outputCol="chars", minTokenLength=1).transform(b)
    g = NGram(n=2, inputCol="chars", outputCol="ngrams").transform(t)
    return g.select(F.explode("ngrams").alias("ngram")).groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------- ids with a plan of their own ----
@register(
    "agg_collect_set",
    "SELECT source, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs FROM documents GROUP BY source",
)
def q_agg_collect_set(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))


@register("filter_min_width", R._L + "SELECT file_id, page_num, x, y, w FROM boxes WHERE w > 50")
def q_filter_min_width(spark, sf_dir):
    return R.line_boxes(spark, sf_dir).filter(F.col("w") > lay.MIN_BOX_WIDTH)


@register(
    "join_left_outer_next_lines",
    _lines_sql() + """SELECT a.doc_id, a.line_no, a.line AS l0, b.line AS l1, c.line AS l2 FROM doc_lines a
LEFT JOIN doc_lines b ON a.doc_id = b.doc_id AND b.line_no = a.line_no + 1
LEFT JOIN doc_lines c ON a.doc_id = c.doc_id AND c.line_no = a.line_no + 2""",
)
def q_join_left_outer_next_lines(spark, sf_dir):
    lines = doc_lines(spark, sf_dir)
    out = lines.select("doc_id", "line_no", F.col("line").alias("l0"))
    for k in (1, 2):
        ahead = lines.select("doc_id", (F.col("line_no") - k).alias("line_no"), F.col("line").alias(f"l{k}"))
        out = out.join(ahead, ["doc_id", "line_no"], "left")
    return out


@register(
    "window_running_group",
    """SELECT conv_id, turn, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
  OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS grp FROM conversations""",
)
def q_window_running_group(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.sum(F.when(F.col("role") == "user", 1).otherwise(0)).over(w).cast("bigint").alias("grp"))


# --------------------------------------------------------------- aliases ----
# Ids whose natural check is a composite query (see README, operator map).
ALIASES = {
    "filter_equality": "project_star",
    "filter_bool_conjunction": "negative_tokens",
    "filter_like_or": "negative_tokens",
    "filter_length": "pair_query",
    "filter_word_count": "exact_match",
    "drop_null_elements": "flatten_three_level",
    "join_inner_equi": "window_neighbors",
    "join_inner_expr_hash": "exact_match",
    "join_row_alignment": "line_align",
    "join_three_way": "align_filtered",
    "join_left_outer": "overlap",
    "join_inner_distinct": "overlap_inner",
    "distinct_select": "line_align",
    "agg_last_by_key": "footer_lines",
    "window_last_matching": "window_neighbors",
    "limit_n": "console_preview",
    "fn_style_key": "html_lines",
    "fn_page_number": "html_lines",
    "fn_explode": "scan_numbered_lines",
    "fn_arithmetic": "agg_having",
    "fn_regexp_extract_all": "negative_tokens",
    "fn_strip_inline_tags": "html_lines",
    "agg_string_concat": "sentence_extract",
    # reference UDFs / RDD maps -> the native operators that replace them
    "udf_extract_tokens": "negative_tokens",
    "udf_parse_html": "html_lines",
    "udf_parse_array": "fn_parse_array_string",
    "udf_image_name": "fn_image_name_parts",
    "udf_parse_para": "paragraph_assemble",
    "map_parse_line": "memory_lookup",
}
# One plan per scalar function: its columns of the projection above.
SCALARS = {
    "fn_lower": ["lower_line"], "fn_regexp_replace": ["normal_form"], "fn_regexp_extract": ["first_number"],
    "fn_split_index": ["second_word"], "fn_word_count": ["word_count"], "fn_substring": ["last_char", "drop_last"],
    "fn_length": ["n_chars"], "fn_case_when": ["ends_with_period"], "fn_concat": ["lang_source"],
    "fn_cast_int": ["first_number_int"], "fn_expr": ["drop_last"], "fn_sha256": ["line_hash", "memory_key"],
    "fn_strip_chars": ["stripped"], "fn_squeeze_spaces": ["squeezed"],
}


def _scalar(cols):
    return lambda spark, sf_dir: q_fn_text_scalars(spark, sf_dir).select("doc_id", "line_no", *cols)


for _id, _cols in SCALARS.items():
    QUERIES[_id] = _scalar(_cols)
    R.ORACLE[_id] = f"SELECT doc_id, line_no, {', '.join(_cols)} FROM ({R.ORACLE['fn_text_scalars']})"
for _alias, _target in ALIASES.items():
    QUERIES[_alias] = QUERIES[_target]
    if _target in R.ORACLE:
        R.ORACLE[_alias] = R.ORACLE[_target]
