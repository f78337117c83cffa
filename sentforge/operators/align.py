"""Line alignment, clean-sentence overlap, multi-language pivot, pair tables.

Joins are written on the text itself (or its normal form), never on a 32-bit
hash, and NULL never matches NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sentforge.functions.text import normal_form
from sentforge.session import staged

# The ten target languages of the multi-language table, in the
# reference's column order.
LANGUAGES: tuple[str, ...] = ("ta", "hi", "bn", "gu", "ka", "ml", "mr", "pa", "te", "ur")


def line_align(
    src: DataFrame, tgt: DataFrame, keys: Sequence[str], src_text: str = "line", tgt_text: str = "line"
) -> DataFrame:
    """Zip two parallel corpora on their line id -> DISTINCT
    (``src_sentence``, ``tgt_sentence``)."""
    s = src.select(*keys, F.col(src_text).alias("src_sentence"))
    t = tgt.select(*keys, F.col(tgt_text).alias("tgt_sentence"))
    return s.join(t, list(keys)).select("src_sentence", "tgt_sentence").distinct()


def align_filtered(
    clean: DataFrame,
    src: DataFrame,
    tgt: DataFrame,
    keys: Sequence[str],
    clean_text: str = "sentence",
    src_text: str = "line",
    tgt_text: str = "line",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Aligned pairs whose (normalised) source is a clean sentence ->
    DISTINCT (``src_sentence`` = source normal form, ``tgt_sentence``).

    The clean list only filters, so it is a semi join (same rows as inner join
    + DISTINCT); it runs first because it is the selective step, so only the
    surviving source lines are shuffled for the line-id join.
    """
    c = clean.select(normal_form(clean_text).alias("_norm")).filter(F.col("_norm") != "")
    s = src.select(*keys, *carry, normal_form(src_text).alias("src_sentence"))
    # '' (blank or non-Latin lines) can never match a clean sentence; dropping
    # it first keeps that very common key out of the semi join's shuffle
    s = s.filter(F.col("src_sentence") != "").join(c, F.col("src_sentence") == c["_norm"], "left_semi")
    t = tgt.select(*keys, F.col(tgt_text).alias("tgt_sentence"))
    return s.join(t, list(keys)).select(*carry, "src_sentence", "tgt_sentence").distinct()


def overlap(
    clean: DataFrame,
    aligned: DataFrame,
    clean_text: str = "sentence",
    normalized: bool = False,
    how: str = "left",
) -> DataFrame:
    """Clean sentences with their translation.

    ``how="left"``: every clean row, NULL ``tgt_sentence`` when untranslated,
    plus ``norm_hash`` (sha-256 of the clean normal form); several
    translations give several rows.  ``how="inner"``: DISTINCT
    (``pdf_sentence``, ``tgt_sentence``) of matching rows only.  The match is
    on the raw text, or on normal forms when ``normalized``.
    """
    key = normal_form(clean_text) if normalized else F.col(clean_text)
    c = clean.select(F.col(clean_text).alias("pdf_sentence"), key.alias("_k"), normal_form(clean_text).alias("_n"))
    akey = normal_form("src_sentence") if normalized else F.col("src_sentence")
    a = aligned.select(akey.alias("_ak"), "tgt_sentence")
    j = c.join(a, c["_k"] == a["_ak"], how)
    if how == "inner":
        return j.select("pdf_sentence", "tgt_sentence").distinct()
    return j.select("pdf_sentence", "tgt_sentence", F.sha2("_n", 256).alias("norm_hash"))


def language_pivot(
    clean: DataFrame,
    aligned: DataFrame,
    languages: Sequence[str] = LANGUAGES,
    clean_text: str = "sentence",
    lang_col: str = "lang",
) -> DataFrame:
    """One column per language for every clean sentence.

    ``aligned``: (``lang``, ``src_sentence`` normal form, ``tgt_sentence``).
    Instead of a chain of left joins, which emits the Cartesian product of all
    translations of a sentence, the distinct translations of each language
    are numbered ``k = 1..m`` and translations with the same ``k`` share a row:
    a sentence gets max-per-language rows, each of bounded width.
    Untranslated sentences get one row with ``k`` and every language NULL.

    Numbering order: (first two hex digits of sha-256(translation),
    translation).  The digits split every (sentence, language) group into up
    to 256 sub-groups numbered in parallel plus a per-group offset table of at
    most 256 rows, so a sentence with a huge number of translations is not
    numbered by one task.
    """
    d = aligned.select(lang_col, "src_sentence", "tgt_sentence").filter(
        F.col(lang_col).isin(*languages) & F.col("tgt_sentence").isNotNull()
    ).distinct()
    # d feeds both the bucket counts and the numbering: written once
    d = staged(d.withColumn("_b", F.substring(F.sha2(F.col("tgt_sentence"), 256), 1, 2)), "translations")
    group = ["src_sentence", lang_col]
    counts = d.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*group, "_b").orderBy("tgt_sentence")
    ranked = d.join(offsets, [*group, "_b"]).withColumn(
        "k", (F.col("_off") + F.row_number().over(w)).cast("bigint"))
    wide = ranked.groupBy("src_sentence", "k").pivot(lang_col, list(languages)).agg(F.first("tgt_sentence"))
    c = clean.select(F.col(clean_text).alias("pdf_sentence"), normal_form(clean_text).alias("_norm"))
    j = c.join(wide, c["_norm"] == wide["src_sentence"], "left")
    return j.select("pdf_sentence", "k", *[F.col(x) for x in languages])


def pair_load(pairs: DataFrame, metadata_schema: StructType | str, metadata_col: str = "metadata_json") -> DataFrame:
    """Parallel pairs -> table with ``src_hash`` (hex sha-256 of ``src``) and
    the parsed metadata fields as columns (malformed JSON -> NULL fields)."""
    parsed = pairs.withColumn("_meta", F.from_json(F.col(metadata_col), metadata_schema, {"mode": "PERMISSIVE"}))
    fields = parsed.schema["_meta"].dataType.fieldNames()
    return parsed.select(
        F.sha2(F.col("src"), 256).alias("src_hash"),
        "src", "tgt", "src_lang", "tgt_lang",
        *[F.col("_meta." + f).alias(f) for f in fields],
    )


def pair_query(pairs: DataFrame, max_src_len: int, label_col: str, label: str, n: int = 10) -> DataFrame:
    """Short pairs with one label: ``length(src) < max_src_len`` and
    ``label_col = label``; the first ``n`` by (src, tgt) - a top-n report."""
    return (
        pairs.filter((F.length("src") < max_src_len) & (F.col(label_col) == label))
        .select("src", "tgt")
        .orderBy("src", "tgt")
        .limit(n)
    )
