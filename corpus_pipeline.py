"""The corpus pipeline: five operators, each on all that the one before kept.

``STAGES`` are ``(name, function)``; a function takes ``(spark, docs, sf_dir)``.
All but the last return the columns of ``documents``; the last returns token
pieces with their place in a packed sequence.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentforge.llm import decontaminate, linededup, packing, quality, simhash
from sentforge.llm.common import stage

TOKENIZER = "byte_bpe_50k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that occur earlier, or nearly so, are cut out of the texts."""
    out = linededup.dedup_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens."""
    pieces = packing.token_pieces(docs, public_tokenizers.path(TOKENIZER))
    return packing.pack(pieces).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: Tokenization, expectation-maximisation and XXH64 have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
