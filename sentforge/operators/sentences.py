"""Rule-based sentence extraction (replaces the pretrained statistical model).

Rule: within one line, words are whitespace-separated; a word ends a sentence
when it ends in ``.``, ``?`` or ``!`` followed by at most three closing marks
(``" ' ” ’ ) ]``), unless it ends in a period and its lower-cased stem (the
trailing ``[a-z0-9.]`` run minus the final period) is a known abbreviation.
Sentences are the words joined by one blank.

Plan (nothing per word is shuffled): each line is split on the JVM into
candidate pieces at every *possible* boundary (look-behind regex), so pieces
are already sentences except where an abbreviation glues two of them.  Only
the last word of each piece is looked up in the abbreviation table.  Pieces
are re-glued with a running sum over (line, piece order) - the only shuffle is
of pieces, i.e. sentence-sized rows, keyed by line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the rule (our own, documented in README).
TERMINALS = ".?!"
CLOSERS = "\"'”’)]"
MAX_CLOSERS = 3

_CLOSER_CLASS = "[" + CLOSERS.replace("]", "\\]") + "]"
BOUNDARY_WORD = "[.?!]" + _CLOSER_CLASS + "{0," + str(MAX_CLOSERS) + "}$"
_SPLIT_AFTER_BOUNDARY = "(?<=[.?!]" + _CLOSER_CLASS + "{0," + str(MAX_CLOSERS) + "}) "
STEM = r"([a-z0-9.]*)\.$"


def numbered_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line_no from 0, line) - ``posexplode`` per row, no shuffle."""
    return docs.select(
        F.col(id_col),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line_no", "line"),
    )


def boundary_pieces(lines: DataFrame, key_cols: Sequence[str], text_col: str) -> DataFrame:
    """Lines cut after every possible sentence end: key columns, ``piece_no``, ``piece`` and ``next_piece`` (null for the last)."""
    keys = [F.col(k) for k in key_cols]
    norm = F.trim(F.regexp_replace(F.col(text_col), r"\s+", " "))
    cut = lines.select(*keys, norm.alias("_norm")).filter(F.col("_norm") != "").select(
        *keys, F.split("_norm", _SPLIT_AFTER_BOUNDARY).alias("_p"))
    zipped = F.transform("_p", lambda x, i: F.struct(x.alias("piece"), F.get("_p", i + 1).alias("next_piece")))
    return cut.select(*keys, F.posexplode(zipped).alias("piece_no", "_x")).select(*keys, "piece_no", "_x.piece", "_x.next_piece")


def join_pieces(pieces: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Pieces (``piece_no``, ``piece``) whose ``_glue`` is set are joined with the next one: key columns, ``sentence_no``, ``sentence``."""
    keys = [F.col(k) for k in key_cols]
    w = Window.partitionBy(*keys).orderBy("piece_no")
    starts = F.when(F.coalesce(F.lag("_glue").over(w), F.lit(False)), 0).otherwise(1)
    pieces = pieces.withColumn("sentence_no", F.sum(starts).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return pieces.groupBy(*keys, "sentence_no").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "piece"))), lambda x: x["piece"]), " "
        ).alias("sentence")
    )


def sentence_split(
    lines: DataFrame,
    abbreviations: DataFrame | None,
    key_cols: Sequence[str] = ("doc_id", "line_no"),
    text_col: str = "line",
) -> DataFrame:
    """One row per sentence occurrence: key columns, ``sentence_no``, ``sentence``.

    ``key_cols`` must identify a line.  ``abbreviations``: first column holds
    lower-case stems without the final period (``negative_tokens`` output).
    """
    keys = [F.col(k) for k in key_cols]
    norm = F.trim(F.regexp_replace(F.col(text_col), r"\s+", " "))
    pieces = (
        lines.select(*keys, norm.alias("_norm"))
        .filter(F.col("_norm") != "")
        .select(*keys, F.posexplode(F.split("_norm", _SPLIT_AFTER_BOUNDARY)).alias("piece_no", "piece"))
    )
    last_word = F.regexp_extract(F.col("piece"), r"([^ ]+)$", 1)
    pieces = pieces.withColumn(
        "_stem", F.when(last_word.endswith("."), F.regexp_extract(F.lower(last_word), STEM, 1))
    )
    if abbreviations is not None:
        abbr = abbreviations.select(F.col(abbreviations.columns[0]).alias("_abbr")).distinct()
        # Only pieces ending in a period can glue.  The others get a unique
        # join key that no abbreviation can equal (it starts with \x01), so
        # in a shuffle join they spread evenly instead of piling up on the
        # partition of the NULL key; a very common stem is split by AQE.
        has_stem = F.col("_stem").isNotNull() & (F.col("_stem") != "")
        unique = F.concat_ws("\x01", F.lit(""), *[k.cast("string") for k in keys], F.col("piece_no").cast("string"))
        pieces = pieces.withColumn("_jk", F.when(has_stem, F.col("_stem")).otherwise(unique))
        pieces = pieces.join(abbr, F.col("_jk") == abbr["_abbr"], "left").withColumn(
            "_glue", F.col("_abbr").isNotNull()).drop("_jk", "_abbr")
    else:
        pieces = pieces.withColumn("_glue", F.lit(False))
    return join_pieces(pieces, key_cols)


def sentence_extract(
    lines: DataFrame,
    abbreviations: DataFrame | None,
    key_cols: Sequence[str] = ("doc_id", "line_no"),
    text_col: str = "line",
) -> DataFrame:
    """Distinct sentences -> one column ``sentence``."""
    return sentence_split(lines, abbreviations, key_cols, text_col).select("sentence").distinct()


def sentence_counts(
    lines: DataFrame,
    abbreviations: DataFrame | None,
    key_cols: Sequence[str] = ("doc_id", "line_no"),
    text_col: str = "line",
) -> DataFrame:
    """Distinct sentences with their number of occurrences (``sentence``, ``n``)."""
    return (
        sentence_split(lines, abbreviations, key_cols, text_col)
        .groupBy("sentence")
        .agg(F.count(F.lit(1)).alias("n"))
    )
