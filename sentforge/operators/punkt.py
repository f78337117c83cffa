"""Sentence boundaries learned from raw text (unsupervised, after Kiss and Strunk).

Training needs one pass over the words: ``word_counts`` folds every word, with
its mark and what stood before it, into counts.  All model tables come from those
counts, so nothing but distinct words and word pairs is ever shuffled:

* ``abbreviations``  words whose final period belongs to them: a log-likelihood
  ratio for "a period follows nearly always" times factors for short words, inner
  periods, and occurrences without a period;
* ``sentence_starters``  words that stand after a sure sentence end more often
  than chance has it;
* ``collocations``  pairs around a doubtful period that belong together;
* ``orthography``  how often a word is written with a capital or a small letter,
  at the start of a sentence and inside one.

The second pass decides each doubtful period (after an abbreviation, a single
letter, a number or an ellipsis) from the tables.  It does so once per distinct
pair of words; lines are cut and joined as in ``sentences.sentence_split``.

Null and blank lines have no words.  Quotation marks count as ASCII and curly
quotes and brackets; case is that of the first character of a word.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.operators.sentences import CLOSERS, MAX_CLOSERS, boundary_pieces, join_pieces
from sentforge.session import cut_lineage

# Fixed values of the method (the published thresholds).
ABBREVIATION_SCORE = 0.3
COLLOCATION_RATIO = 7.88
STARTER_RATIO = 30.0
PERIOD_RATE = 0.99

NUMBER = "##number##"
OPENERS = "\"'“‘(["
_CLOSE = "[" + CLOSERS.replace("]", "\\]") + "]{0," + str(MAX_CLOSERS) + "}$"
_OPEN = "^[" + OPENERS.replace("[", "\\[") + "]+"
NUMBER_RULE = "^[-+]?[0-9][0-9.,:/-]*$"
WORD_RULE = "[a-z\\x{80}-\\x{10FFFF}]"
_TINY = 1e-300


@dataclass(frozen=True)
class Word:
    """What the method sees of a written word."""

    mark: Column  # dots, dot, stop or none
    kind: Column  # the word in small letters without its final mark; numbers are one
    case: Column  # U, L or N (first character)
    soft: Column  # starts with a mark that goes on with the sentence


def word_parts(word: Column) -> Word:
    core = F.regexp_replace(F.regexp_replace(word, _OPEN, ""), _CLOSE, "")
    mark = F.when(core.rlike(r"\.\.$"), "dots").when(core.endswith("."), "dot").when(core.rlike("[?!]$"), "stop").otherwise("none")
    bare = F.regexp_replace(F.regexp_replace(F.lower(core), "[.?!]$", ""), "[,;:]+$", "")
    kind = F.when(core.rlike(r"\.\.$"), "..").when(bare.rlike(NUMBER_RULE), NUMBER).otherwise(bare)
    first = F.substring(core, 1, 1)
    case = F.when(F.upper(first) == F.lower(first), "N").when(first == F.upper(first), "U").when(first == F.lower(first), "L").otherwise("N")
    return Word(mark, kind, case, first.isin(",", ";", ":", "."))


def word_counts(lines: DataFrame, text_col: str = "line") -> DataFrame:
    """Counts of ``(before, before_kind, kind, mark, case)``: ``before`` is the mark of the word above in the line
    (``start`` for the first), ``before_kind`` that word where it ends in a period.  Written once; every model table reads it."""
    norm = F.trim(F.regexp_replace(F.col(text_col), r"\s+", " "))
    words = lines.select(F.split(norm, " ").alias("w")).select(F.explode(F.arrays_zip(
        F.col("w").alias("w"), F.concat(F.array(F.lit(None).cast("string")), F.col("w")).alias("p"))).alias("x")).select("x.w", "x.p")
    words = words.filter(F.col("w").isNotNull() & (F.col("w") != ""))
    w, p = word_parts(F.col("w")), word_parts(F.col("p"))
    before = F.when(F.col("p").isNull(), "start").otherwise(p.mark)
    counted = words.select(before.alias("before"), F.when(F.col("p").isNotNull() & (p.mark == "dot"), p.kind).alias("before_kind"),
                           w.kind.alias("kind"), w.mark.alias("mark"), w.case.alias("case"))
    counts = counted.groupBy("before", "before_kind", "kind", "mark", "case").agg(F.count(F.lit(1)).alias("n"))
    return cut_lineage(counts)


def _log(k: Column, n: Column, p: Column) -> Column:
    """Log likelihood of ``k`` of ``n`` at rate ``p``."""
    return k * F.log(F.greatest(p, F.lit(_TINY))) + (n - k) * F.log(F.greatest(1 - p, F.lit(_TINY)))


def likelihood_ratio(both: Column, first: Column, second: Column, n: Column) -> Column:
    """Dunning's ratio for a pair: ``both`` together, ``first`` and ``second`` alone, of ``n`` words."""
    rest, others = second - both, n - first
    p, p1, p2 = second / n, both / first, rest / others
    return 2 * (_log(both, first, p1) + _log(rest, others, p2) - _log(both, first, p) - _log(rest, others, p))


def _total(counts: DataFrame) -> Column:
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double")).scalar()


def abbreviations(counts: DataFrame, threshold: float = ABBREVIATION_SCORE) -> DataFrame:
    """``kind``, ``with_period``, ``without_period`` and ``score`` of the words above the threshold."""
    ends = counts.groupBy("kind").agg(
        F.sum(F.when(F.col("mark") == "dot", F.col("n")).otherwise(0)).alias("with_period"), F.sum("n").alias("all"))
    ends = ends.filter((F.col("with_period") > 0) & F.col("kind").rlike(WORD_RULE) & (F.col("kind") != NUMBER))
    n = _total(counts)
    rate = F.greatest(F.least(_total(counts.filter("mark = 'dot'")) / n, F.lit(1 - 1e-12)), F.lit(1e-12))
    k, m = F.col("with_period").cast("double"), F.col("all").cast("double")
    ratio = -2 * (k * F.log(rate) + (m - k) * F.log(1 - rate) - k * F.log(F.lit(PERIOD_RATE)) - (m - k) * F.log(F.lit(1 - PERIOD_RATE)))
    periods = F.length("kind") - F.length(F.replace("kind", F.lit("."), F.lit("")))
    letters = (F.length("kind") - periods).cast("double")
    score = ratio * (periods + 1) * F.exp(-letters - (m - k) * F.log(letters))
    return ends.filter(letters > 0).select("kind", "with_period", (F.col("all") - F.col("with_period")).alias("without_period"),
                                           score.alias("score")).filter(F.col("score") >= threshold)


def _doubtful(counts: DataFrame, known: DataFrame) -> DataFrame:
    """The counts with ``context``: sure (after a sentence end), doubtful (after a period that may not be one), inside, start."""
    a = known.select(F.col("kind").alias("_a")).distinct()
    joined = counts.join(a, F.col("before_kind") == F.col("_a"), "left")
    ambiguous = (F.col("before") == "dots") | F.col("_a").isNotNull() | (F.col("before_kind") == NUMBER) | (F.length("before_kind") == 1)
    context = F.when(F.col("before") == "start", "start").when(F.col("before") == "none", "inside").when(
        F.col("before") == "stop", "sure").when(F.coalesce(ambiguous, F.lit(False)), "doubtful").otherwise("sure")
    return joined.withColumn("context", context).drop("_a")


def sentence_starters(counts: DataFrame, known: DataFrame, threshold: float = STARTER_RATIO) -> DataFrame:
    """``kind``, ``after_end``, ``n`` and ``ratio`` of the words that start sentences. ``known``: abbreviations (column ``kind``)."""
    marked = _doubtful(counts, known)
    ends = _total(marked.filter("context = 'sure'"))
    n = _total(counts)
    words = marked.groupBy("kind").agg(F.sum(F.when(F.col("context") == "sure", F.col("n")).otherwise(0)).alias("after_end"), F.sum("n").alias("n"))
    words = words.filter((F.col("after_end") > 0) & F.col("kind").rlike(WORD_RULE) & (F.col("kind") != NUMBER))
    both, second = F.col("after_end").cast("double"), F.col("n").cast("double")
    ratio = likelihood_ratio(both, ends, second, n)
    return words.select("kind", "after_end", "n", ratio.alias("ratio")).filter((F.col("ratio") >= threshold) & (both * n > ends * second))


def collocations(counts: DataFrame, known: DataFrame, starters: DataFrame, threshold: float = COLLOCATION_RATIO) -> DataFrame:
    """``first``, ``second``, ``n_both`` and ``ratio`` of pairs that belong together across a doubtful period."""
    n = _total(counts)
    pairs = _doubtful(counts, known).filter("context = 'doubtful' and before = 'dot'").groupBy(
        F.col("before_kind").alias("first"), F.col("kind").alias("second")).agg(F.sum("n").alias("n_both"))
    pairs = pairs.filter((F.col("n_both") > 1) & F.col("second").rlike(WORD_RULE) & (F.col("second") != NUMBER))
    firsts = counts.filter("mark = 'dot'").groupBy(F.col("kind").alias("first")).agg(F.sum("n").alias("n_first"))
    seconds = counts.groupBy(F.col("kind").alias("second")).agg(F.sum("n").alias("n_second"))
    j = pairs.join(firsts, "first").join(seconds, "second").join(starters.select(F.col("kind").alias("second")), "second", "left_anti")
    both, first, second = (F.col(c).cast("double") for c in ("n_both", "n_first", "n_second"))
    return j.select("first", "second", "n_both", likelihood_ratio(both, first, second, n).alias("ratio"), (both * n > first * second).alias("_more")).filter(
        (F.col("ratio") >= threshold) & F.col("_more")).drop("_more")


def orthography(counts: DataFrame, known: DataFrame) -> DataFrame:
    """Per ``kind``: ``upper``, ``lower``, ``upper_inside`` (after a word without a mark) and ``lower_start`` (after a sure end, or first in a line)."""
    c, n = F.col("case"), F.col("n")
    of = lambda what, name: F.sum(F.when(what, n).otherwise(0)).alias(name)
    begins = F.col("context").isin("start", "sure")
    return _doubtful(counts, known).groupBy("kind").agg(
        of(c == "U", "upper"), of(c == "L", "lower"), of((c == "U") & (F.col("context") == "inside"), "upper_inside"),
        of((c == "L") & begins, "lower_start"))


@dataclass(frozen=True)
class Model:
    """The learned tables. ``abbreviations`` may be joined by given ones (column ``kind``)."""

    abbreviations: DataFrame
    starters: DataFrame
    collocations: DataFrame
    orthography: DataFrame


def train(lines: DataFrame, extra_abbreviations: DataFrame | None = None, text_col: str = "line") -> Model:
    """All tables from raw lines; ``extra_abbreviations`` (first column: small letters, no final period) are taken as known."""
    counts = word_counts(lines, text_col)
    known = abbreviations(counts).select("kind")
    if extra_abbreviations is not None:
        known = known.unionByName(extra_abbreviations.select(F.col(extra_abbreviations.columns[0]).alias("kind")))
    known = known.distinct()
    starters = sentence_starters(counts, known)
    return Model(known, starters, collocations(counts, known, starters), orthography(counts, known))


def _decisions(pairs: DataFrame, model: Model) -> DataFrame:
    """Whether a sentence ends between two words, for every distinct pair around a period."""
    flag = F.lit(True)
    j = (pairs.join(model.abbreviations.select(F.col("kind").alias("k1"), flag.alias("abbr")), "k1", "left")
         .join(model.collocations.select(F.col("first").alias("k1"), F.col("second").alias("k2"), flag.alias("pair")), ["k1", "k2"], "left")
         .join(model.starters.select(F.col("kind").alias("k2"), flag.alias("starter")), "k2", "left")
         .join(model.orthography.withColumnRenamed("kind", "k2"), "k2", "left"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    upper, lower = F.col("case2") == "U", F.col("case2") == "L"
    starts = yes(upper & (F.col("lower") > 0) & (F.col("upper_inside") == 0))
    inside = F.col("soft2") | yes(lower & ((F.col("upper") > 0) | (F.col("lower_start") == 0)))
    abbr = (F.col("mark1") == "dots") | yes(F.col("abbr"))
    initial = (F.length("k1") == 1) & F.col("k1").rlike(WORD_RULE)
    never_small = yes(upper & (F.coalesce(F.col("lower"), F.lit(0)) == 0))
    ends = (F.when(yes(F.col("pair")) | F.col("soft2"), False)
            .when(abbr, starts | (upper & yes(F.col("starter"))))
            .when(initial, ~inside & ~(~starts & never_small))
            .when(F.col("k1") == NUMBER, ~inside)
            .otherwise(True))
    return j.select("mark1", "k1", "k2", "case2", "soft2", ends.alias("ends"))


def punkt_split(lines: DataFrame, model: Model, key_cols: Sequence[str] = ("doc_id", "line_no"), text_col: str = "line") -> DataFrame:
    """One row per sentence occurrence: key columns, ``sentence_no``, ``sentence``."""
    pieces = boundary_pieces(lines, key_cols, text_col)  # cut after every possible end
    last = word_parts(F.regexp_extract("piece", r"([^ ]+)$", 1))
    following = word_parts(F.regexp_extract("next_piece", r"^([^ ]+)", 1))
    pieces = pieces.withColumns({"mark1": last.mark, "k1": last.kind, "k2": following.kind, "case2": following.case, "soft2": following.soft})
    key = ["mark1", "k1", "k2", "case2", "soft2"]
    asked = F.col("next_piece").isNotNull() & F.col("mark1").isin("dot", "dots")
    decided = _decisions(pieces.filter(asked).select(*key).distinct(), model).filter(~F.col("ends")).select(
        *[F.col(k).alias("_" + k) for k in key])  # the pairs that do not end a sentence
    same = F.lit(True)
    for k in key:
        same = same & (F.col(k) == F.col("_" + k))
    glued = pieces.join(decided, same & asked, "left").withColumn("_glue", F.col("_k1").isNotNull())
    return join_pieces(glued, key_cols)


def punkt_sentences(lines: DataFrame, model: Model, key_cols: Sequence[str] = ("doc_id", "line_no"), text_col: str = "line") -> DataFrame:
    """Distinct sentences with their number of occurrences (``sentence``, ``n``)."""
    return punkt_split(lines, model, key_cols, text_col).groupBy("sentence").agg(F.count(F.lit(1)).alias("n"))
