"""Test-table access and the derived inputs every query binding shares.

Everything here is a lazy DataFrame over the parquet tables, so each query's
work grows with the tables.  The matching DuckDB fragments live next to the
Spark code in ``sentforge.plans.registry``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentforge.operators.sentences import numbered_lines

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, line_no, line, lang, source) - every line of every document."""
    d = documents(spark, sf_dir)
    return d.select(
        "doc_id", "lang", "source",
        F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("line_no", "line"),
    )


def bench_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, line_no, line) - every line of the benchmark passages."""
    b = table(spark, sf_dir, "benchmark")
    return numbered_lines(b, "item_id", "text")


def default_tokens(spark: SparkSession) -> DataFrame:
    """The positive (never-abbreviation) token list used by the bindings."""
    return spark.createDataFrame([(t,) for t in DEFAULT_TOKEN_LIST], "default_token string")


# Positive tokens of the test binding (a parameter, not data).
DEFAULT_TOKEN_LIST = ("end", "12", "no")
