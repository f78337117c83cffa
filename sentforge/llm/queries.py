"""Bindings of the pipeline operators to the test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentforge.llm import conversations, decontaminate, langid, linededup, packing, quality, recompress, resampling, sharding, simhash, substrings, toxicity, warc

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(p).withColumnRenamed("id", "doc_id")


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = quality.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return j.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.remainder("doc_id", 5) == 0)
    model = toxicity.train(docs.filter("not held_out"), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.remainder("doc_id", 4) == 2)
    return langid.identify(docs, langid.train(docs.filter("not held_out")), keep=["doc_id", "held_out"])


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = resampling.target_sample(table(spark, sf_dir, "labels"))
    return resampling.resample(table(spark, sf_dir, "documents"), target, keep=["doc_id"])


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    r = warc.read(warc.archive(spark, pages), with_payload=False)
    kind = pages.schema["page_id"].dataType
    return r.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
                    F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, html, strlen(html) AS n, sha1(html) || '0' AS x FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(x, (1 + (5 * i) // 4)::INT, 3))::INT >> (7 - (5 * i) % 4)::INT) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = max(page_id) OVER (PARTITION BY html) THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> max(page_id) OVER (PARTITION BY html) THEN max(page_id) OVER (PARTITION BY html) END AS refers_to
FROM h
"""


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return d.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"),
                    F.col("_n_near").alias("n_near"), F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op1_line_dedup"] = r"""
WITH parts AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
occ AS (SELECT doc_id, pos, raw, trim(raw, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line FROM parts),
first AS (SELECT line, min((doc_id, pos)) AS f FROM occ WHERE line <> '' GROUP BY line),
late AS (SELECT DISTINCT CASE WHEN a.f < b.f THEN b.line ELSE a.line END AS line
  FROM first a JOIN first b ON a.line < b.line AND abs(strlen(a.line) - strlen(b.line)) <= 2
   AND strlen(a.line) >= 24 AND strlen(b.line) >= 24 AND levenshtein(a.line, b.line) <= 2),
judged AS (SELECT o.doc_id, o.pos, o.raw, o.line <> '' AS word, o.line <> '' AND (o.doc_id, o.pos) <> f.f AS again,
  o.line <> '' AND (o.doc_id, o.pos) = f.f AND l.line IS NOT NULL AS near
  FROM occ o LEFT JOIN first f ON o.line = f.line LEFT JOIN late l ON o.line = l.line)
SELECT doc_id, count(*) FILTER (word) AS n_lines, count(*) FILTER (again OR near) AS n_removed, count(*) FILTER (near) AS n_near,
  sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT coalesce(again OR near, false)), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = substrings.cut_spans(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return d.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.byte_shards(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return s.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The table of CRC-32, by its rule.
_CRC_TABLE = """tab AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) r(b))"""

ORACLE["op12_sharding"] = f"WITH {_CRC_TABLE}," + """
d AS (SELECT doc_id, (coalesce(strlen(text), 0) + 8)::BIGINT AS size,
  xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32 FROM documents, tab),
p AS (SELECT *, sum(size) OVER (ORDER BY doc_id) AS upto, sum(size) OVER () AS whole FROM d),
s AS (SELECT *, ((2 * upto - size) * 24 // (2 * whole))::INTEGER AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
  NULL::INTEGER AS grown_shard FROM s
"""


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = recompress.find_runs(table(spark, sf_dir, "documents"), plant=True, keep=["doc_id"], texts=False)
    best = recompress.longest_run(F.col("runs"))
    return r.select("row.doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
                    best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256")


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    r = conversations.repair_conversations(conversations.damaged(rows)).withColumnRenamed("conv", "_conv")
    ids = rows.select("conv_id").distinct()
    zero = lambda name: F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)
    return ids.join(r, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


ORACLE["op11_conversation_repair"] = f"WITH RECURSIVE {_CRC_TABLE}," + """
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'),
    lambda x: ('0x' || x)::BIGINT), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 20 AS what FROM conversations, tab),
e AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN what = 1 THEN '' WHEN what = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS k FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, k) AS i,
  right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS z FROM e),
f AS (SELECT *, CASE WHEN z = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN z NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS r,
  left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS met FROM o),
edges(p, q, c, a, kind, init) AS (SELECT p, q, c + x, a || y, kind, init FROM
  (VALUES (0, 0, 0, ''), (0, 2, 5, 'I'), (0, 3, 10, 'II'), (1, 1, 0, ''), (1, 2, 5, 'I'), (1, 3, 10, 'II'),
          (2, 2, 0, ''), (2, 3, 5, 'I'), (2, 2, 10, 'II'), (3, 3, 0, ''), (3, 2, 5, 'I'), (3, 3, 10, 'II')) g(p, m, c, a),
  (VALUES (0, 0, 2, 'D', 'any', ''), (1, 1, 2, 'D', 'any', ''), (2, 2, 2, 'D', 'any', ''), (3, 3, 2, 'D', 'any', ''),
          (0, 2, 1, 'R', 'stay', ''), (1, 2, 1, 'R', 'stay', ''), (3, 2, 1, 'R', 'stay', ''), (2, 3, 1, 'R', 'stay', ''),
          (0, 1, 0, 'K', 'stay', 's'), (0, 2, 0, 'K', 'stay', 'u'), (1, 2, 0, 'K', 'stay', 'u'), (3, 2, 0, 'K', 'stay', 'u'),
          (2, 3, 0, 'K', 'stay', 'a')) h(s, q, x, y, kind, init) WHERE s = m),
w AS (SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit FROM o WHERE i = 1
  UNION ALL
  SELECT conv_id, i, q, cost, audit FROM (
    SELECT w.conv_id, f.i, g.q, w.cost + g.c + CASE WHEN f.fault = 'truncated' AND g.kind = 'stay' THEN 5 ELSE 0 END AS cost, w.audit || g.a AS audit
    FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN edges g ON g.p = w.state AND (g.kind = 'any' OR f.fault NOT IN ('blank', 'duplicate')) AND g.init IN ('', f.r))
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
n AS (SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (met NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
best AS (SELECT w.conv_id, cost + [0, 10, 5, 0][state + 1] AS cost, audit || ['', 'II', 'I', ''][state + 1] AS audit
  FROM w JOIN n ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND w.i = n.rows
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY cost + [0, 10, 5, 0][state + 1], audit || ['', 'II', 'I', ''][state + 1]) = 1),
ops AS (SELECT conv_id, k, audit[k] AS op, len(replace(replace(left(audit, k), 'I', ''), ' ', '')) AS i,
  FROM (SELECT conv_id, audit, unnest(range(1, len(audit) + 1)) AS k FROM best)),
said AS (SELECT ops.conv_id, ops.k, ops.op, f.role, f.text, f.r, count(*) OVER (PARTITION BY ops.conv_id ORDER BY ops.k) AS m,
    max(CASE WHEN ops.op = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY ops.conv_id) AS s
  FROM ops LEFT JOIN f ON ops.conv_id IS NOT DISTINCT FROM f.conv_id AND ops.i = f.i AND ops.op <> 'I' WHERE ops.op <> 'D'),
lines AS (SELECT conv_id, k, CASE WHEN op = 'K' THEN role ELSE CASE WHEN (m - s) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' ||
    CASE WHEN op = 'I' THEN '' ELSE text END AS line FROM said),
told AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS text FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(told.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN best ON c.conv_id IS NOT DISTINCT FROM best.conv_id LEFT JOIN told ON c.conv_id IS NOT DISTINCT FROM told.conv_id
"""
