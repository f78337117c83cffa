"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0).  Expectation-maximisation
over the counts of vote patterns estimates, for either class, how often each
rule gives each vote, and the share of good documents; the posterior
probability of *good* given a document's votes decides.  There are at most
``3 ** len(RULES)`` patterns, so the counts are a small table at any input size.

Edge cases: a null or empty text has no words and fails the base rule; repeated
rows are judged alike; an empty table gives an empty result; the input's other
columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import chain_hash, let, stage, white_words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
THRESHOLD = 0.5
ROUNDS = 50
#: Where EM starts: P(good), and P(votes bad | it votes) in good and in bad documents.
START_GOOD = 0.8
START_BAD_VOTE = (0.001, 0.3)
#: Virtual documents behind the starting rates, and the most often that a rule may fault a good document.
WEIGHT = 2.0
MAX_FALSE = 0.01


def _repeat_words(hashes: Column, words: int = WINDOW) -> Column:
    """Elements covered by windows (given by their hashes) that occur twice or more."""
    def covered(rows: Column) -> Column:
        same = lambda x, at: F.coalesce(F.get(rows, at)["h"] == x["h"], F.lit(False))
        twin = F.filter(rows, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return let(F.array_sort(F.transform(twin, lambda x: x["i"])), lambda at: F.aggregate(
            F.zip_with(at, F.slice(at, 2, F.size(at)), lambda a, b: F.coalesce(F.least(b - a, F.lit(words)), F.lit(words))),
            F.lit(0), lambda acc, x: acc + x))

    rows = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(rows, covered))


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns in the struct ``row``, and the statistics of every whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.struct(*(keep or docs.columns)).alias("row"), text.alias("text"), white_words(F.col(text_col)).alias("words"))
    d = d.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    d = d.withColumn("windows", chain_hash(F.col("hashes"), WINDOW))
    with_word = F.filter(F.split("text", "\n"), lambda x: F.rtrim(F.translate(x, "\t\x0b\x0c\r", "    ")) != "")
    d = d.withColumn("lines", with_word)
    removed = lambda chars: F.length("text") - F.length(F.translate("text", chars, ""))
    return d.select(
        "row",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        removed(SYMBOLS).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("windows")).cast("bigint").alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("words") - F.size(F.array_distinct("hashes"))).cast("bigint").alias("n_again"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("bigint").alias("n_upper"),
        removed("!?").cast("bigint").alias("n_marks"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes from the statistics' columns: 1 good, -1 bad, 0 abstain."""
    c = F.col
    n, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    mean = c("word_chars") / n
    symbols, marks = c("n_symbols") / n, c("n_marks") / n
    upper = c("n_upper") / F.greatest(c("word_chars"), F.lit(1))
    again = c("n_again") / n
    dup = c("n_dup_lines") / lines
    return {
        "length": _vote(c("n_words") >= 50, c("n_words") < MIN_WORDS),
        "mean_word": _vote((mean >= 3) & (mean <= 10), (mean < 2) | (mean > 15)),
        "symbols": _vote(symbols <= 0.02, symbols > 0.1),
        "capitals": _vote(upper <= 0.15, upper > 0.4),
        "marks": _vote(marks <= 0.05, marks > 0.5),
        "lines": _vote((c("n_lines") >= 2) & (dup <= 0.05), dup > 0.5),
        "words": _vote((c("n_words") >= 50) & (again <= 0.75), (c("n_words") < 400) & (again > 0.85)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = ROUNDS):
    """EM on ``(votes, count)``; returns P(good) and, by class (good, bad) and
    rule, the rate of bad votes among its votes.  Abstaining tells nothing."""
    prior, rates = START_GOOD, [[r] * n_rules for r in START_BAD_VOTE]
    total = sum(c for _, c in patterns)
    for _ in range(rounds if total else 0):
        bad = [[WEIGHT * r] * n_rules for r in START_BAD_VOTE]
        cast = [[WEIGHT] * n_rules for _ in START_BAD_VOTE]
        good = WEIGHT * START_GOOD
        for votes, count in patterns:
            g = posterior(votes, prior, rates)
            good += g * count
            for j, v in enumerate(votes):
                for side, mass in enumerate((g * count, (1 - g) * count)) if v else ():
                    cast[side][j] += mass
                    bad[side][j] += mass * (v < 0)
        prior = min(max(good / (total + WEIGHT), 0.01), 0.99)
        rates = [[b / c for b, c in zip(*x, strict=True)] for x in zip(bad, cast, strict=True)]
        rates[0] = [min(r, MAX_FALSE) for r in rates[0]]
    return prior, rates


def weights(prior: float, rates) -> tuple[float, list[tuple[float, float]]]:
    """Log odds of good: the prior's, and each rule's for a bad and for a good vote."""
    clip = lambda r: min(max(r, 1e-6), 1 - 1e-6)
    pairs = [(clip(g), clip(b)) for g, b in zip(*rates, strict=True)]
    return math.log(prior / (1 - prior)), [(math.log(g / b), math.log((1 - g) / (1 - b))) for g, b in pairs]


def posterior(votes, prior: float, rates) -> float:
    odds, each = weights(prior, rates)
    odds += sum(w[0] if v < 0 else w[1] for v, w in zip(votes, each, strict=True) if v)
    return 1 / (1 + math.exp(-odds))


def judge(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``keep`` columns), the statistics, ``base_failed``,
    ``quality`` (posterior probability of good) and ``kept``."""
    votes = rules()
    names = [f"v_{k}" for k in votes]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = stage(statistics(docs, text_col, keep).withColumn("base_failed", failed).select(
        "*", *[v.alias(n) for n, v in zip(names, votes.values(), strict=True)]), "votes")
    # what the base rule rejects teaches nothing about the rest; at most 3 ** len(rules) rows
    counts = scored.filter("not base_failed").groupBy(*names).count().orderBy(*names).collect()
    patterns = [(tuple(r[:-1]), r[-1]) for r in counts]
    prior, each = weights(*fit(patterns, len(names)))
    odds = F.lit(prior)
    for n, (bad, good) in zip(names, each, strict=True):
        odds = odds + F.when(F.col(n) < 0, bad).when(F.col(n) > 0, good).otherwise(0.0)
    return (scored.withColumn("quality", 1 / (1 + F.exp(-odds)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= THRESHOLD)))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the rules keep; same columns as ``docs``."""
    return judge(docs, text_col).filter("kept").select("row.*")
