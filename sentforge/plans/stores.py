"""Bindings of the file-based stores, sources and sinks: each query writes given tables and reads them back."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sentforge.operators import memory as mem
from sentforge.plans import oracle_sql as o
from sentforge.plans import registry as R
from sentforge.plans.registry import _with, register
from sentforge.plans.tables import doc_lines, table
from sentforge.session import shared_folder
from sentforge.sources import collection
from sentforge.sources import memory_store as store
from sentforge.sources import readers, sinks, splits


# ---------------------------------------------------------------- memory ----
def _filled(spark, sf_dir):
    """A store with three layers: the memory, the misses of all requests, and a correction of every line of language en."""
    kept = store.create(spark, shared_folder(spark, "memory"), R._memory(spark, sf_dir, unique=False))
    misses = store.lookup(kept, R._requests(spark, sf_dir), "hi").filter("not hit")
    new = mem.memory_rows(misses, R._translate("source_sentence"), F.lit("und"), F.lit("hi"), text_col="source_sentence", unique=False)
    kept = store.put(kept, new)
    lines = doc_lines(spark, sf_dir).filter((F.col("lang") == "en") & (F.col("line") != ""))
    fixed = mem.memory_rows(lines.select(F.col("line").alias("sentence")), F.concat(F.lit("[hi, checked] "), F.col("sentence")), F.lit("en"), F.lit("hi"), unique=False)
    return store.put(kept, fixed)


_STORE_SQL = _with(o.DOC_LINES, R._MEM_SQL) + """
, new AS (SELECT 'hi_' || sha256(source_sentence) AS key, '[hi] ' || source_sentence AS target_sentence, source_sentence,
                 'und' AS source_language, 'hi' AS target_language FROM looked WHERE NOT hit),
fixed AS (SELECT DISTINCT 'hi_' || sha256(line) AS key, '[hi, checked] ' || line AS target_sentence, line AS source_sentence,
                 'en' AS source_language, 'hi' AS target_language FROM doc_lines WHERE lang = 'en' AND line <> ''),
layers AS (SELECT 0 AS n, * FROM mem UNION ALL SELECT 1, * FROM new UNION ALL SELECT 2, * FROM fixed),
merged AS (SELECT key, source_sentence, target_sentence, source_language, target_language FROM layers
           QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC) = 1)
"""


@register("external_kv_table", _STORE_SQL + "SELECT * FROM merged")
def q_external_kv_table(spark, sf_dir):
    return store.scan(_filled(spark, sf_dir))


@register("memory_put", _STORE_SQL + "SELECT target_language, source_language, left(target_sentence, 4) AS mark, count(*)::BIGINT AS n FROM merged GROUP BY ALL")
def q_memory_put(spark, sf_dir):
    kept = store.open_store(spark, _filled(spark, sf_dir).path)  # as another session would
    return store.scan(kept).groupBy("target_language", "source_language", F.substring("target_sentence", 1, 4).alias("mark")).agg(F.count(F.lit(1)).alias("n"))


@register("memory_compact", _STORE_SQL + "SELECT * FROM merged")
def q_memory_compact(spark, sf_dir):
    return store.scan(store.compact(_filled(spark, sf_dir)))


@register("memory_point_get", _STORE_SQL + "SELECT * FROM merged WHERE source_sentence = (SELECT min(line) FROM doc_lines WHERE lang = 'en' AND line <> '')")
def q_memory_point_get(spark, sf_dir):
    first = doc_lines(spark, sf_dir).filter((F.col("lang") == "en") & (F.col("line") != "")).agg(F.min("line")).first()[0]
    return store.get_sentence(_filled(spark, sf_dir), first or "", "hi")


@register("join_memory_lookup", _STORE_SQL + """, asked AS (SELECT DISTINCT line AS source_sentence FROM doc_lines)
SELECT a.source_sentence, m.target_sentence, m.key IS NOT NULL AS hit FROM asked a LEFT JOIN merged m ON 'hi_' || sha256(a.source_sentence) = m.key""")
def q_join_memory_lookup(spark, sf_dir):
    return store.lookup(_filled(spark, sf_dir), doc_lines(spark, sf_dir), "hi", text_col="line")


@register("join_memory_miss", _STORE_SQL + "SELECT source_sentence FROM looked WHERE NOT hit")
def q_join_memory_miss(spark, sf_dir):
    kept = store.create(spark, shared_folder(spark, "memory"), R._memory(spark, sf_dir, unique=False))
    return store.lookup(kept, R._requests(spark, sf_dir), "hi").filter("not hit").select("source_sentence")


# ---------------------------------------------------- files of the tables ----
_DOC_COLUMNS = "doc_id bigint, lang string, source string, text string"


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")


def _csv_of_documents(spark, sf_dir) -> str:
    """Documents with their line breaks and quotes as quoted CSV."""
    path = shared_folder(spark, "documents.csv")
    sinks.write_csv(_documents(spark, sf_dir), path)
    return path


@register("scan_csv_multiline", "SELECT doc_id, lang, source, text FROM documents")
def q_scan_csv_multiline(spark, sf_dir):
    return readers.read_csv_multiline(spark, _csv_of_documents(spark, sf_dir), _DOC_COLUMNS)


@register("scan_numbered_files", _with(o.DOC_LINES) + """SELECT line, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS row_id FROM doc_lines""")
def q_scan_numbered_files(spark, sf_dir):
    """Lines written in document order over several files, numbered from the files."""
    path = shared_folder(spark, "lines")
    lines = doc_lines(spark, sf_dir).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "line_no")
    sinks.write_text(lines.select("line"), path)
    return splits.numbered_lines(spark, path, "line").select("line", "row_id")


_LINES = _with(o.DOC_LINES)


def _line_files(spark, sf_dir, fmt: str) -> str:
    """(doc_id, line_no, line) of every line as CSV, TSV or text files."""
    path = shared_folder(spark, f"lines.{fmt}")
    rows = doc_lines(spark, sf_dir).select("doc_id", "line_no", "line")
    if fmt == "txt":
        sinks.write_text(rows.select("line"), path)
    else:
        rows.write.options(sep="\t" if fmt == "tsv" else ",", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return path


_ROW = "doc_id bigint, line_no int, line string"


@register("scan_csv_schema", _LINES + "SELECT doc_id, line_no, line FROM doc_lines")
def q_scan_csv_schema(spark, sf_dir):
    return readers.read_csv(spark, _line_files(spark, sf_dir, "csv"), _ROW)


@register("scan_tsv", _LINES + "SELECT doc_id, line_no, line FROM doc_lines")
def q_scan_tsv(spark, sf_dir):
    return readers.read_tsv(spark, _line_files(spark, sf_dir, "tsv"), _ROW)


@register("scan_csv_glob", _LINES + "SELECT doc_id, line_no, line FROM doc_lines")
def q_scan_csv_glob(spark, sf_dir):
    return readers.read_csv(spark, _line_files(spark, sf_dir, "csv") + "/part-*", _ROW)


@register("scan_line_csv", _LINES + "SELECT line AS sentences, count(*)::BIGINT AS n FROM doc_lines WHERE line <> '' GROUP BY line")
def q_scan_line_csv(spark, sf_dir):
    lines = readers.read_line_csv(spark, _line_files(spark, sf_dir, "txt"))
    return lines.groupBy("sentences").agg(F.count(F.lit(1)).alias("n"))


@register("scan_stage_output", _with(o.negative_tokens_cte()) + "SELECT token FROM neg_tokens")
def q_scan_stage_output(spark, sf_dir):
    """Negative tokens written by one stage and read by the next."""
    path = shared_folder(spark, "neg-tokens")
    sinks.write_text(R.neg_tokens(spark, sf_dir), path)
    return readers.read_stage_output(spark, path)


@register("sink_text_single", _LINES + "SELECT line, count(*)::BIGINT AS n FROM doc_lines GROUP BY line")
def q_sink_text(spark, sf_dir):
    return readers.read_lines(spark, _line_files(spark, sf_dir, "txt")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@register("scan_whole_files", "SELECT count(*)::BIGINT AS files, sum(length(html))::BIGINT AS chars FROM pages")
def q_scan_whole_files(spark, sf_dir):
    """Every page as a file of its own, read back whole."""
    path = shared_folder(spark, "pages")
    pages = table(spark, sf_dir, "pages").select("html")
    # a file a row in one folder that is listed once; tasks move their files there themselves, not the driver one by one.
    # A page has no such character, so a file is a page.
    pages.write.options(lineSep="\x01", maxRecordsPerFile="1", **{"mapreduce.fileoutputcommitter.algorithm.version": "2"}).text(path)
    whole = readers.read_whole_files(spark, path).select(F.expr("substr(content, 1, length(content) - 1)").alias("html"))
    return whole.agg(F.count(F.lit(1)).alias("files"), F.sum(F.length("html")).alias("chars"))


@register("sink_csv_header", _LINES + "SELECT lang, count(*)::BIGINT AS n_lines FROM doc_lines GROUP BY lang")
def q_sink_csv_header(spark, sf_dir):
    path = shared_folder(spark, "counts.csv")
    sinks.write_csv(doc_lines(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n_lines")), path, single_file=True)  # a row per language
    return readers.read_csv(spark, path, "lang string, n_lines bigint", header=True)


@register("sink_csv_error_if_exists", "SELECT true AS refused, (SELECT count(*) FROM benchmark)::BIGINT AS n")
def q_sink_csv_error(spark, sf_dir):
    """A second write to the same folder is refused and leaves the first as it was."""
    path = shared_folder(spark, "items.csv")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    sinks.write_csv(items, path)
    refused = False
    try:
        sinks.write_csv(items.limit(1), path)
    except AnalysisException:
        refused = True
    back = readers.read_csv_multiline(spark, path, "item_id string, text string")
    return back.agg(F.lit(refused).alias("refused"), F.count(F.lit(1)).alias("n")).select("refused", "n")


@register("sink_parquet", "SELECT doc_id, lang, source, text FROM documents")
def q_sink_parquet(spark, sf_dir):
    path = shared_folder(spark, "documents.parquet")
    sinks.write_parquet(_documents(spark, sf_dir), path)
    return spark.read.schema(_DOC_COLUMNS).parquet(path)


@register("sink_sentence_lines", _with(*R._SENT_CTES) + "SELECT sentence, count(*)::BIGINT AS n FROM sent GROUP BY sentence")
def q_sink_sentence_lines(spark, sf_dir):
    path = shared_folder(spark, "sentences")
    sinks.write_text(R._sentences(spark, sf_dir).select("sentence"), path)
    return readers.read_lines(spark, path, "sentence").groupBy("sentence").agg(F.count(F.lit(1)).alias("n"))


def _catalog_table(spark, sf_dir) -> str:
    """A table of the session catalog over a folder, declared by DDL, and filled by INSERT ... SELECT."""
    path = shared_folder(spark, "customers")
    name = f"customers_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} (c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE) USING parquet LOCATION '{path}'")
    sinks.insert_into(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_acctbal").cast("double")), name)
    return name


@register("catalog_ddl", "SELECT column_name, data_type, (SELECT count(*) FROM customer)::BIGINT AS n FROM (VALUES ('c_custkey', 'bigint'), ('c_name', 'string'), ('c_acctbal', 'double')) v(column_name, data_type)")
def q_catalog_ddl(spark, sf_dir):
    name = _catalog_table(spark, sf_dir)
    found = spark.sql(f"DESCRIBE TABLE {name}")
    return found.select(F.col("col_name").alias("column_name"), "data_type", spark.table(name).agg(F.count(F.lit(1))).scalar().alias("n"))


@register("sink_insert_select", "SELECT c_custkey::BIGINT AS c_custkey, c_name, c_acctbal::DOUBLE AS c_acctbal FROM customer")
def q_sink_insert_select(spark, sf_dir):
    return spark.table(_catalog_table(spark, sf_dir))


# ------------------------------------------------------- writes by source ----
_SOURCES_SQL = _LINES + """SELECT source, CASE WHEN source IN (SELECT min(source) FROM documents UNION SELECT max(source) FROM documents)
  THEN '* ' || line ELSE line END AS line, count(*)::BIGINT AS n FROM doc_lines GROUP BY ALL"""


@register("partition_by_source", _SOURCES_SQL)
def q_partition_by_source(spark, sf_dir):
    """Lines written by source, two sources written again with a mark, everything read back."""
    path = shared_folder(spark, "by-source")
    lines = doc_lines(spark, sf_dir).select("source", "line")
    size = F.octet_length("line").cast("bigint") + 1
    sinks.write_balanced(lines, path, "source", size)
    ends = lines.agg(F.min("source"), F.max("source")).first()
    again = lines.filter(F.col("source").isin(*ends)).withColumn("line", F.concat(F.lit("* "), F.col("line")))
    sinks.write_balanced(again, path, "source", size, only=True)
    return spark.read.schema("line string, source string").parquet(path).groupBy("source", "line").agg(F.count(F.lit(1)).alias("n"))


@register("sink_partitioned", _LINES + "SELECT lang, count(*)::BIGINT AS n, sum(length(line))::BIGINT AS chars FROM doc_lines GROUP BY lang")
def q_sink_partitioned(spark, sf_dir):
    path = shared_folder(spark, "by-language")
    sinks.write_partitioned(doc_lines(spark, sf_dir).select("lang", "line"), path, "lang", fmt="parquet", files_per_value=4)
    return spark.read.schema("line string, lang string").parquet(path).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("line")).alias("chars"))


# ---------------------------------------------------- document collection ----
def _collection(spark, sf_dir) -> str:
    """Documents with nested ids, appended to a collection in one write per language."""
    collection.register(spark)
    path = shared_folder(spark, "collection")
    docs = _documents(spark, sf_dir).select(F.struct(F.col("doc_id").cast("string").alias("oid")).alias("_id"), "doc_id", "lang", "source", "text")
    for lang in [r["lang"] for r in docs.select("lang").distinct().orderBy("lang").collect()]:  # a handful
        part = docs.filter(F.col("lang").eqNullSafe(F.lit(lang)))
        part.write.format(collection.NAME).mode("append").save(path)
    return path


@register("sink_append_collection", "SELECT doc_id::VARCHAR AS oid, doc_id, lang, source, text FROM documents")
def q_sink_append_collection(spark, sf_dir):
    back = spark.read.format(collection.NAME).load(_collection(spark, sf_dir))
    return back.select("_id.oid", "doc_id", "lang", "source", "text")


@register("scan_document_collection", "SELECT doc_id::VARCHAR AS oid, source, text FROM documents WHERE lang = 'en' AND doc_id >= 100 AND source IS NOT NULL")
def q_scan_document_collection(spark, sf_dir):
    """English documents from id 100 on: parts of other languages are not opened, the rest is filtered in the source."""
    back = spark.read.format(collection.NAME).load(_collection(spark, sf_dir))
    return back.filter((F.col("lang") == "en") & (F.col("doc_id") >= 100) & F.col("source").isNotNull()).select("_id.oid", "source", "text")
