"""The stages together, and the registration."""

import re

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__
from sentforge.llm import decontaminate, linededup, quality, simhash
from sentforge.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_names_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert len([q for q in QUERIES if re.match(rf"op{n}_", q)]) == 1
    assert set(QUERIES) <= set(names) and "pipeline" in names and set(ORACLE) <= set(__spark_entry__.oracle_sql())
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_follow_the_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    a = corpus_pipeline.keep_good(spark, docs, SF)
    good = {r.row.doc_id for r in quality.judge(docs, keep=["doc_id"]).collect() if r.kept}
    assert {r.doc_id for r in a.collect()} == good and a.columns == docs.columns
    b = corpus_pipeline.dedup_lines(spark, a, SF)
    assert {r.doc_id: r.text for r in b.collect()} == {r.doc_id: r.text for r in linededup.dedup_lines(a).collect()}
    assert b.columns == docs.columns and b.filter(F.col("n_chars") != F.char_length("text")).count() == 0
    c = corpus_pipeline.drop_near_duplicates(spark, b, SF)
    groups = {r.component_id for r in simhash.near_duplicate_groups(b).collect()}
    assert {r.doc_id for r in c.collect()} == groups and c.columns == docs.columns
    d = corpus_pipeline.drop_contaminated(spark, c, SF)
    clean = {r.id for r in decontaminate.contamination(c, items).collect() if not r.n_hit}
    assert {r.doc_id for r in d.collect()} == clean and d.columns == docs.columns
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == clean


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
