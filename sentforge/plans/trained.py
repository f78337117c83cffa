"""Bindings of the learned sentence model: its tables and the sentences it gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentforge.operators import punkt
from sentforge.plans import oracle_sql as o
from sentforge.plans.registry import _with, neg_tokens, register
from sentforge.plans.tables import doc_lines


def _parts(w: str, n: str = "") -> str:
    """SQL of ``punkt.word_parts``: columns mark, kind, case and soft (with suffix ``n``)."""
    core = f"regexp_replace(regexp_replace({w}, {o.q(punkt._OPEN)}, ''), {o.q(punkt._CLOSE)}, '')"
    bare = f"regexp_replace(regexp_replace(lower({core}), '[.?!]$', ''), '[,;:]+$', '')"
    first = f"left({core}, 1)"
    return f"""CASE WHEN regexp_matches({core}, '\\.\\.$') THEN 'dots' WHEN {core} LIKE '%.' THEN 'dot'
       WHEN regexp_matches({core}, '[?!]$') THEN 'stop' ELSE 'none' END AS mark{n},
  CASE WHEN regexp_matches({core}, '\\.\\.$') THEN '..' WHEN regexp_matches({bare}, {o.q(punkt.NUMBER_RULE)}) THEN '{punkt.NUMBER}' ELSE {bare} END AS kind{n},
  CASE WHEN upper({first}) = lower({first}) THEN 'N' WHEN {first} = upper({first}) THEN 'U' WHEN {first} = lower({first}) THEN 'L' ELSE 'N' END AS wcase{n},
  {first} IN (',', ';', ':', '.') AS soft{n}"""


def _log(k: str, n: str, p: str) -> str:
    return f"({k} * ln(greatest({p}, 1e-300)) + ({n} - {k}) * ln(greatest(1 - {p}, 1e-300)))"


def _ratio(both: str, first: str, second: str, n: str) -> str:
    rest, others = f"({second} - {both})", f"({n} - {first})"
    p, p1, p2 = f"({second} / {n})", f"({both} / {first})", f"({rest} / {others})"
    return f"(2 * ({_log(both, first, p1)} + {_log(rest, others, p2)} - {_log(both, first, p)} - {_log(rest, others, p)}))"


_IS_WORD = f"regexp_matches(kind, {o.q(punkt.WORD_RULE)}) AND kind <> '{punkt.NUMBER}'"
_WORDS = f"""pw AS (SELECT doc_id, line_no, unnest(string_split(norm, ' ')) AS w, generate_subscripts(string_split(norm, ' '), 1) AS pos
  FROM (SELECT doc_id, line_no, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS norm FROM doc_lines) WHERE norm <> ''),
pp AS (SELECT doc_id, line_no, pos, w, {_parts('w')} FROM pw),
pt AS (SELECT *, lag(mark) OVER l AS pmark, lag(kind) OVER l AS pkind, lead(kind) OVER l AS nkind, lead(wcase) OVER l AS ncase, lead(soft) OVER l AS nsoft
  FROM pp WINDOW l AS (PARTITION BY doc_id, line_no ORDER BY pos)),
pn AS (SELECT count(*)::DOUBLE AS n, greatest(least(count(*) FILTER (mark = 'dot')::DOUBLE / count(*), 1 - 1e-12), 1e-12) AS rate FROM pt),
pk AS (SELECT kind, count(*) AS m, count(*) FILTER (mark = 'dot') AS k, length(kind) - length(replace(kind, '.', '')) AS dots,
    length(replace(kind, '.', ''))::DOUBLE AS letters FROM pt WHERE {_IS_WORD} GROUP BY kind),
pa AS (SELECT kind, k::BIGINT AS with_period, (m - k)::BIGINT AS without_period,
    -2 * (k * ln(rate) + (m - k) * ln(1 - rate) - k * ln({punkt.PERIOD_RATE}) - (m - k) * ln(1 - {punkt.PERIOD_RATE}))
      * (dots + 1) * exp(-letters - (m - k) * ln(letters)) AS score
  FROM pk, pn WHERE k > 0 AND letters > 0),
found AS (SELECT * FROM pa WHERE score >= {punkt.ABBREVIATION_SCORE}),
known AS (SELECT kind FROM found UNION SELECT token FROM neg_tokens),
px AS (SELECT *, CASE WHEN pmark IS NULL THEN 'start' WHEN pmark = 'none' THEN 'inside' WHEN pmark = 'stop' THEN 'sure'
    WHEN pmark = 'dots' OR pkind IN (SELECT kind FROM known) OR pkind = '{punkt.NUMBER}' OR length(pkind) = 1 THEN 'doubtful' ELSE 'sure' END AS context FROM pt),
pe AS (SELECT count(*) FILTER (context = 'sure')::DOUBLE AS ends FROM px),
ps AS (SELECT kind, count(*) FILTER (context = 'sure') AS after_end, count(*) AS m FROM px WHERE {_IS_WORD} GROUP BY kind),
starters AS (SELECT kind, after_end, m AS n, {_ratio('after_end', 'pe.ends', 'm', 'pn.n')} AS ratio FROM ps, pe, pn
  WHERE after_end > 0 AND {_ratio('after_end', 'pe.ends', 'm', 'pn.n')} >= {punkt.STARTER_RATIO} AND after_end * pn.n > pe.ends * m),
pc AS (SELECT pkind AS first, kind AS second, count(*) AS n_both FROM px WHERE context = 'doubtful' AND pmark = 'dot' AND {_IS_WORD} GROUP BY ALL),
colls AS (SELECT pc.first, pc.second, n_both, {_ratio('n_both', 'a.c', 'b.c', 'pn.n')} AS ratio FROM pc
  JOIN (SELECT kind, count(*) AS c FROM pt WHERE mark = 'dot' GROUP BY kind) a ON a.kind = pc.first
  JOIN (SELECT kind, count(*) AS c FROM pt GROUP BY kind) b ON b.kind = pc.second, pn
  WHERE n_both > 1 AND second NOT IN (SELECT kind FROM starters) AND n_both * pn.n > a.c * b.c AND {_ratio('n_both', 'a.c', 'b.c', 'pn.n')} >= {punkt.COLLOCATION_RATIO}),
ortho AS (SELECT kind, count(*) FILTER (wcase = 'U') AS upper, count(*) FILTER (wcase = 'L') AS lower,
    count(*) FILTER (wcase = 'U' AND context = 'inside') AS upper_inside,
    count(*) FILTER (wcase = 'L' AND context IN ('start', 'sure')) AS lower_start FROM px GROUP BY kind)"""

_MODEL = _with(o.negative_tokens_cte(), o.DOC_LINES, _WORDS)
_GOES_ON = f"""(coalesce(p.nsoft, false) OR colls.n_both IS NOT NULL OR CASE
    WHEN p.mark = 'dots' OR known.kind IS NOT NULL THEN NOT coalesce((p.ncase = 'U' AND ortho.lower > 0 AND ortho.upper_inside = 0)
      OR (p.ncase = 'U' AND starters.kind IS NOT NULL), false)
    WHEN length(p.kind) = 1 AND regexp_matches(p.kind, {o.q(punkt.WORD_RULE)}) THEN coalesce(p.ncase = 'L' AND (ortho.upper > 0 OR ortho.lower_start = 0), false)
      OR coalesce(p.ncase = 'U' AND coalesce(ortho.lower, 0) = 0, false)
    WHEN p.kind = '{punkt.NUMBER}' THEN coalesce(p.ncase = 'L' AND (ortho.upper > 0 OR ortho.lower_start = 0), false)
    ELSE false END)"""
_SENTENCES = f""", pb AS (SELECT p.doc_id, p.line_no, p.pos, p.w, CASE WHEN regexp_matches(p.w, {o.q("[.?!][" + chr(34) + "'”’)" + chr(92) + "]]{0,3}$")})
    AND NOT (p.mark IN ('dot', 'dots') AND p.nkind IS NOT NULL AND {_GOES_ON}) THEN 1 ELSE 0 END AS b
  FROM pt p LEFT JOIN known ON known.kind = p.kind LEFT JOIN colls ON colls.first = p.kind AND colls.second = p.nkind
  LEFT JOIN starters ON starters.kind = p.nkind LEFT JOIN ortho ON ortho.kind = p.nkind),
pi AS (SELECT *, coalesce(sum(b) OVER (PARTITION BY doc_id, line_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM pb),
pq AS (SELECT doc_id, line_no, no, string_agg(w, ' ' ORDER BY pos) AS sentence FROM pi GROUP BY ALL)"""


def _known(spark, sf_dir, counts):
    found = punkt.abbreviations(counts).select("kind")
    return found.unionByName(neg_tokens(spark, sf_dir).select(F.col("token").alias("kind"))).distinct()


@register("sentence_model_abbreviations", _MODEL + "SELECT kind, with_period, without_period, round(score, 4) AS score FROM found")
def q_abbreviations(spark, sf_dir):
    return punkt.abbreviations(punkt.word_counts(doc_lines(spark, sf_dir))).withColumn("score", F.round("score", 4))


@register("sentence_model_starters", _MODEL + "SELECT kind, after_end, n, round(ratio, 4) AS ratio FROM starters")
def q_starters(spark, sf_dir):
    counts = punkt.word_counts(doc_lines(spark, sf_dir))
    return punkt.sentence_starters(counts, _known(spark, sf_dir, counts)).withColumn("ratio", F.round("ratio", 4))


@register("sentence_model_collocations", _MODEL + "SELECT first, second, n_both, round(ratio, 4) AS ratio FROM colls")
def q_collocations(spark, sf_dir):
    counts = punkt.word_counts(doc_lines(spark, sf_dir))
    known = _known(spark, sf_dir, counts)
    found = punkt.collocations(counts, known, punkt.sentence_starters(counts, known))
    return found.withColumn("ratio", F.round("ratio", 4))


@register("sentence_model_orthography", _MODEL + "SELECT kind, upper, lower, upper_inside, lower_start FROM ortho")
def q_orthography(spark, sf_dir):
    counts = punkt.word_counts(doc_lines(spark, sf_dir))
    return punkt.orthography(counts, _known(spark, sf_dir, counts))


@register("udf_sentence_tokenize", _MODEL + _SENTENCES + "SELECT sentence, count(*)::BIGINT AS n FROM pq GROUP BY sentence")
def q_sentence_tokenize(spark, sf_dir):
    lines = doc_lines(spark, sf_dir)
    return punkt.punkt_sentences(lines, punkt.train(lines, neg_tokens(spark, sf_dir)))
