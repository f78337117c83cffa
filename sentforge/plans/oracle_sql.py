"""DuckDB SQL fragments for the oracle side of every query binding.

The oracle computes the same definition a different way (word-level brute
force, plain joins, original regex text) so the comparison is a real check of
the Spark plans, not a restatement of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from sentforge.operators.tokens import DEFAULT_EXTRA_TOKENS, DEFAULT_RULES, effective_rules
from sentforge.plans.tables import DEFAULT_TOKEN_LIST


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def values(rows: Sequence[str], col: str) -> str:
    return "(SELECT * FROM (VALUES " + ", ".join("(" + q(r) + ")" for r in rows) + f") v({col}))"


NORMAL_FORM = "regexp_replace(lower({x}), '[^a-zA-Z0-9 ]+', '', 'g')"


def normal_form(x: str) -> str:
    return NORMAL_FORM.format(x=x)


DOC_LINES = """doc_lines AS (
  SELECT doc_id, lang, source,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         (generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1)::INTEGER AS line_no
  FROM documents)"""

BENCH_LINES = """bench_lines AS (
  SELECT item_id,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         (generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1)::INTEGER AS line_no
  FROM benchmark)"""


def negative_tokens_cte(name: str = "neg_tokens", source: str = "documents", text_col: str = "text") -> str:
    rules = effective_rules(DEFAULT_RULES)
    extract = " || ".join(f"regexp_extract_all(token, {q('(?i)' + r)}, 0)" for r in rules)
    extra = [t[:-1] if t.endswith(".") else t for t in DEFAULT_EXTRA_TOKENS]
    return f"""{name}_tok AS (
  SELECT DISTINCT t AS token
  FROM (SELECT unnest(regexp_split_to_array(lower(coalesce({text_col}, '')), '\\s')) AS t FROM {source})
  WHERE t LIKE '%.%'),
{name}_m AS (SELECT DISTINCT unnest({extract}) AS ntoken FROM {name}_tok),
{name}_f AS (
  SELECT substr(ntoken, 1, length(ntoken) - 1) AS token FROM {name}_m
  WHERE ntoken LIKE '%.' AND length(ntoken) > 3 AND length(ntoken) < 50),
{name} AS (
  SELECT token FROM {name}_f WHERE token LIKE '%.%' OR length(token) < 4
  UNION SELECT token FROM {values(extra, 'token')}
  EXCEPT SELECT token FROM {values(DEFAULT_TOKEN_LIST, 'token')})"""


def sentence_words_cte(lines: str, keys: str, abbr: str, name: str = "sent") -> str:
    """Word-level definition of sentence splitting over ``lines(keys..., line)``."""
    boundary = q("[.?!][\"'”’)\\]]{0,3}$")
    stem = "regexp_extract(lower(w), '([a-z0-9.]*)\\.$', 1)"
    return f"""{name}_norm AS (
  SELECT {keys}, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS norm FROM {lines}),
{name}_words AS (
  SELECT {keys}, unnest(string_split(norm, ' ')) AS w, generate_subscripts(string_split(norm, ' '), 1) AS pos
  FROM {name}_norm WHERE norm <> ''),
{name}_flags AS (
  SELECT {keys}, w, pos,
         CASE WHEN regexp_matches(w, {boundary})
                   AND NOT (w LIKE '%.' AND {stem} <> '' AND {stem} IN (SELECT token FROM {abbr}))
              THEN 1 ELSE 0 END AS b
  FROM {name}_words),
{name}_ids AS (
  SELECT *, coalesce(sum(b) OVER (PARTITION BY {keys} ORDER BY pos
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence_no
  FROM {name}_flags),
{name} AS (
  SELECT {keys}, sentence_no, string_agg(w, ' ' ORDER BY pos) AS sentence
  FROM {name}_ids GROUP BY {keys}, sentence_no)"""
