"""The left join chain over many languages, kept as a product until it is read.

A chain of left joins gives every combination of a sentence's translations, one
of each language.  Here a sentence is one *factorised* row: an array of its
translations per language and the number of combinations, which is the product
of the array sizes (an empty array counts one, a null).  Combination ``i`` is
read off by mixed radix: the languages' sizes are the radices, the digits of
``i`` the places in the arrays.  Numbers of combinations are dealt to tasks as
ranges, so a sentence with a million combinations is written by many tasks and
no join ever multiplies rows.

Edge cases: a sentence without translations in a language has null there, as in
the chain; null sentences and null translations of a known sentence are kept
(one row, and one null element); repeated (language, sentence, translation) rows
count once; more combinations than a 64-bit number are an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = 10_000  # combinations that a task enumerates at once


def factorised(clean: DataFrame, aligned: DataFrame, languages: Sequence[str], clean_text: str = "sentence", lang_col: str = "lang") -> DataFrame:
    """``clean`` rows with the struct ``translations`` (an array of structs (t) per language) and ``combinations``.

    ``aligned``: ``lang_col``, ``src_sentence``, ``tgt_sentence``. One shuffle by sentence folds all languages."""
    rows = aligned.filter(F.col("src_sentence").isNotNull()).select(lang_col, "src_sentence", "tgt_sentence").distinct()
    per = [F.array_sort(F.collect_list(F.when(F.col(lang_col) == x, F.struct(F.col("tgt_sentence").alias("t"))))).alias(f"l{i}") for i, x in enumerate(languages)]
    arrays = rows.groupBy(F.col("src_sentence").alias("_src")).agg(*per)
    empty = F.array().cast("array<struct<t: string>>")
    joined = clean.join(arrays, F.col(clean_text) == F.col("_src"), "left")
    lists = [F.coalesce(F.col(f"l{i}"), empty).alias(f"l{i}") for i in range(len(languages))]
    out = joined.select(*clean.columns, F.struct(*lists).alias("translations"))
    product = F.lit(1).cast("bigint")
    for i in range(len(languages)):
        product = product * F.greatest(F.size(f"translations.l{i}"), F.lit(1))
    return out.withColumn("combinations", product)


def enumerated(rows: DataFrame, languages: Sequence[str], keep: Sequence[str], span: int = RANGE) -> DataFrame:
    """Every combination of ``factorised`` rows: the ``keep`` columns and a column per language."""
    few = rows.filter(F.col("combinations") <= span).withColumn("_from", F.lit(0).cast("bigint"))
    many = rows.filter(F.col("combinations") > span).withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("combinations") - 1, F.lit(span).cast("bigint"))))
    many = many.repartition(*[F.col(c) for c in keep], F.col("_from"))  # a range is a row: they spread over all tasks
    ranges = few.unionByName(many)
    to = F.least(F.col("_from") + span, F.col("combinations")) - 1
    numbered = ranges.withColumn("_i", F.explode(F.sequence("_from", to)))
    rest, columns = F.col("_i"), []
    for i, lang in reversed(list(enumerate(languages))):  # the last language turns fastest
        size = F.greatest(F.size(f"translations.l{i}"), F.lit(1)).cast("bigint")
        columns.append(F.get(F.col(f"translations.l{i}"), F.pmod(rest, size).cast("int"))["t"].alias(lang))
        rest = F.call_function("div", rest, size)
    return numbered.select(*keep, *reversed(columns))


def left_join_chain(clean: DataFrame, aligned: DataFrame, languages: Sequence[str], clean_text: str = "sentence", lang_col: str = "lang") -> DataFrame:
    """``pdf_sentence`` and one column per language: what the chain of left joins gives."""
    rows = factorised(clean.select(F.col(clean_text).alias("pdf_sentence")), aligned, languages, "pdf_sentence", lang_col)
    return enumerated(rows, languages, ["pdf_sentence"])
