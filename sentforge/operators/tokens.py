"""Negative-token (abbreviation) extraction.

Plan: tokens = split(lower(text), whitespace) -> keep tokens containing a
period (no rule can match without one, so this is exact and shrinks the data
before the first shuffle) -> distinct (partial aggregation map-side) -> all
rule matches (JVM ``regexp_extract_all``, run on distinct tokens only) ->
explode -> distinct -> length / trailing-period filters -> UNION extra tokens
-> EXCEPT default tokens (broadcast left-anti when the default list is small).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# ---------------------------------------------------------------------------
# The default token-extraction rules and extra tokens of the
# reference configuration, verbatim and in their original order.
# ---------------------------------------------------------------------------
DEFAULT_RULES: tuple[str, ...] = (
    r"(?:([a-z0-9]*\.)[a-z0-9]+(\.)*)+",
    r"(?:([a-z0-9]*\.)([a-z0-9]+(\.))([a-z0-9]+))",
    r"(?:([a-z0-9]*\.)([a-z0-9]+(\.))+)",
    r"(?:([a-z]{0-4}\.)+)",
    r"(?:([a-z0-9]*\.)+)",
)
DEFAULT_EXTRA_TOKENS: tuple[str, ...] = ("it.", "him.", "adv.")
DEFAULT_MIN_LEN = 3
DEFAULT_MAX_LEN = 50
# ---------------------------------------------------------------------------


# The fourth rule's quantifier is written ``{0-4}``.  Python reads it as the
# literal text "{0-4}" and the JVM rejects it.  Default: the intended bounded
# repetition ``{0,4}``; strict: the literal reading (braces escaped).
RULE4_INTENT = r"(?:([a-z]{0,4}\.)+)"
RULE4_LITERAL = r"(?:([a-z]\{0-4\}\.)+)"

# Rules whose nested, repeated groups make java.util.regex recurse once per
# repetition (a token of a few thousand periods overflows the executor thread
# stack and kills the JVM) are executed in an equivalent form: the same
# leftmost-first matches, but with possessive quantifiers, which the JVM runs
# iteratively.  Equivalence holds because in each rule a repetition can only
# end where the next character cannot continue it, so backtracking never finds
# a different match; tests/test_tokens.py checks this against Python ``re``
# on random tokens.  DuckDB (RE2) and Python run the original text.
_JVM_FORM = {
    DEFAULT_RULES[0]: r"(?:[a-z0-9]*+\.[a-z0-9]++\.*+)++",
    DEFAULT_RULES[1]: r"[a-z0-9]*\.[a-z0-9]+\.[a-z0-9]+",
    DEFAULT_RULES[2]: r"[a-z0-9]*+\.(?:[a-z0-9]++\.)++",
    RULE4_INTENT: r"(?:[a-z]{0,4}+\.)++",
    RULE4_LITERAL: r"(?:[a-z]\{0-4\}\.)++",
    # a maximal run of [a-z0-9.] cut back to its last period
    DEFAULT_RULES[4]: r"[a-z0-9.]*\.",
}


def effective_rules(rules: Sequence[str] = DEFAULT_RULES, strict: bool = False) -> list[str]:
    """Rules as the reference means them (``strict`` keeps the literal braces)."""
    out = []
    for r in rules:
        if r == DEFAULT_RULES[3]:
            out.append(RULE4_LITERAL if strict else RULE4_INTENT)
        else:
            out.append(r)
    return out


def jvm_rule(rule: str) -> str:
    """Case-insensitive JVM form of one rule."""
    return "(?i)" + _JVM_FORM.get(rule, rule)


def dotted_tokens(sentences: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct lower-cased whitespace tokens that contain a period."""
    tok = F.explode(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"\s")).alias("token")
    return sentences.select(tok).filter(F.col("token").contains(".")).distinct()


def rule_matches(tokens: DataFrame, rules: Sequence[str], token_col: str = "token") -> DataFrame:
    """Distinct whole matches of every rule (non-overlapping, left to right)."""
    arrays = [F.regexp_extract_all(F.col(token_col), F.lit(jvm_rule(r)), 0) for r in rules]
    all_matches = arrays[0] if len(arrays) == 1 else F.concat(*arrays)
    return tokens.select(F.explode(all_matches).alias("ntoken")).distinct()


def negative_tokens(
    sentences: DataFrame,
    default_tokens: DataFrame | None = None,
    extra_tokens: Iterable[str] = DEFAULT_EXTRA_TOKENS,
    rules: Sequence[str] = DEFAULT_RULES,
    min_len: int = DEFAULT_MIN_LEN,
    max_len: int = DEFAULT_MAX_LEN,
    text_col: str = "text",
    strict: bool = False,
) -> DataFrame:
    """Abbreviation-like tokens of a text column -> one column ``token``.

    A match is kept when it ends with a period and ``min_len < length <
    max_len`` (strict bounds); the final period is dropped; the rest must still
    contain a period or be shorter than 4 characters.  Extra tokens are added
    (their final period dropped unless ``strict``) and ``default_tokens`` (first
    column) are removed.  Result is distinct (EXCEPT DISTINCT semantics).
    """
    spark: SparkSession = sentences.sparkSession
    matches = rule_matches(dotted_tokens(sentences, text_col), effective_rules(rules, strict))
    n = F.col("ntoken")
    kept = (
        matches.filter(n.endswith(".") & (F.length(n) > min_len) & (F.length(n) < max_len))
        .select(F.expr("substring(ntoken, 1, length(ntoken) - 1)").alias("token"))
        .filter(F.col("token").contains(".") | (F.length("token") < 4))
    )
    extra = [t for t in extra_tokens]
    if not strict:
        extra = [t[:-1] if t.endswith(".") else t for t in extra]
    if extra:
        kept = kept.unionByName(spark.createDataFrame([(t,) for t in extra], "token string"))
    result = kept.distinct()
    if default_tokens is not None:
        d = default_tokens.select(F.col(default_tokens.columns[0]).alias("token")).distinct()
        # EXCEPT DISTINCT as a NULL-safe anti join; the planner picks the side
        # to broadcast from its own size estimate
        result = result.join(d, result["token"].eqNullSafe(d["token"]), "left_anti")
    return result


def token_order(tokens: DataFrame, ascending: bool | None = True, seed: int = 17, token_col: str = "token") -> DataFrame:
    """Insertion order of tokens: by length ascending (True), descending
    (False) or seeded random (None); ties broken by the token itself."""
    t = F.col(token_col)
    if ascending is None:
        return tokens.orderBy(F.rand(seed), t)
    length = F.length(t)
    return tokens.orderBy(length.asc() if ascending else length.desc(), t.asc())
