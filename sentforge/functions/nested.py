"""Flattening nested responses (arrays of structs of arrays) into rows.

Each level is an ``explode``/``inline`` in the same task - no shuffle; NULL
elements are skipped, empty or NULL arrays give no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_two_level(df: DataFrame, keep: Sequence[str] = (), outer: str = "data", inner: str = "text") -> DataFrame:
    """``data[].text[]`` -> one row per string (column ``text``)."""
    a = df.select(*keep, F.explode(outer).alias("_o"))
    return a.select(*keep, F.explode(F.col("_o")[inner]).alias(inner)).filter(F.col(inner).isNotNull())


def flatten_blocks(df: DataFrame, keep: Sequence[str] = (), outer: str = "result", blocks: str = "text_blocks",
                   field: str = "text") -> DataFrame:
    """``result[].text_blocks[].text`` -> one row per block text."""
    a = df.select(*keep, F.explode(outer).alias("_o"))
    b = a.select(*keep, F.explode(F.col("_o")[blocks]).alias("_b")).filter(F.col("_b").isNotNull())
    return b.select(*keep, F.col("_b")[field].alias(field))


def flatten_three_level(df: DataFrame, keep: Sequence[str] = (), outer: str = "result", blocks: str = "text_blocks",
                        sentences: str = "tokenized_sentences", field: str = "src") -> DataFrame:
    """``result[].text_blocks[].tokenized_sentences[].src`` -> one row per
    sentence; NULL sentence entries are skipped."""
    a = df.select(*keep, F.explode(outer).alias("_o"))
    b = a.select(*keep, F.explode(F.col("_o")[blocks]).alias("_b")).filter(F.col("_b").isNotNull())
    s = b.select(*keep, F.explode(F.col("_b")[sentences]).alias("_s")).filter(F.col("_s").isNotNull())
    return s.select(*keep, F.col("_s")[field].alias(field))
