"""The factorised chain against real left joins, ranks against sorting, balanced writes."""

import os
import random

from pyspark.sql import functions as F

from sentforge.operators import chain, paging
from sentforge.sources import sinks

LANGS = ["ta", "hi", "bn", "gu"]


def chain_of_joins(clean, aligned):
    out = clean.select(F.col("sentence").alias("pdf_sentence"))
    for x in LANGS:
        side = aligned.filter(F.col("lang") == x).select("src_sentence", F.col("tgt_sentence").alias(x)).distinct()
        out = out.join(side, F.col("pdf_sentence") == F.col("src_sentence"), "left").drop("src_sentence")
    return out.select("pdf_sentence", *LANGS)


def rows(df):
    return sorted(map(str, df.collect()))


def test_enumeration_equals_the_joins(spark):
    r = random.Random(4)
    clean = spark.createDataFrame([(f"s{i % 40}",) for i in range(60)] + [(None,), ("none",)], "sentence string")
    data = [(r.choice([*LANGS, "xx", None]), r.choice([f"s{r.randrange(40)}", None]), r.choice([None, "a", "b", "c"])) for _ in range(300)]
    aligned = spark.createDataFrame(data, "lang string, src_sentence string, tgt_sentence string")
    assert rows(chain.left_join_chain(clean, aligned, LANGS)) == rows(chain_of_joins(clean, aligned))
    small = chain.enumerated(chain.factorised(clean, aligned, LANGS), LANGS, ["sentence"], span=3).withColumnRenamed("sentence", "pdf_sentence")
    assert rows(small) == rows(chain_of_joins(clean, aligned))
    assert rows(chain.left_join_chain(clean, aligned.limit(0), LANGS)) == rows(chain_of_joins(clean, aligned.limit(0)))
    assert chain.left_join_chain(clean.limit(0), aligned, LANGS).count() == 0


def test_a_large_product_is_dealt_over_tasks(spark):
    clean = spark.createDataFrame([("hot",), ("cold",)], "sentence string")
    aligned = spark.createDataFrame([(x, "hot", f"{x}{i}") for x in LANGS for i in range(20)], "lang string, src_sentence string, tgt_sentence string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = chain.enumerated(chain.factorised(clean, aligned, LANGS), LANGS, ["sentence"], span=1000)
        sizes = [x["count"] for x in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20 ** 4 + 1 and max(sizes) < 0.5 * 20 ** 4
        assert out.distinct().count() == 20 ** 4 + 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_ranks_equal_sorting(spark):
    r = random.Random(5)
    data = [(r.choice([None, "a", "b"]), r.choice([None, *range(30)]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "s string, n int, id int").repartition(5)
    want = sorted(data, key=lambda x: tuple((v is not None, v or 0 if not isinstance(v, str) else v) for v in x))
    got = sorted(paging.ranked(df, ["s", "n", "id"]).collect(), key=lambda x: x["rank"])
    assert [tuple(x)[:3] for x in got] == want and [x["rank"] for x in got] == list(range(1, 3001))
    table = paging.ranked(df, ["s", "n", "id"])
    assert sorted(x.id for x in paging.page(table, 7, 50).collect()) == sorted(x[2] for x in want[300:350])
    assert paging.page(table, 900, 50).count() == 0 and paging.ranked(df.limit(0), ["s"]).count() == 0
    last, seen = None, []
    for _ in range(4):
        part = paging.page_after(df, ["s", "n", "id"], 400, last).collect()
        seen += [tuple(x) for x in part]
        last = seen[-1]
    assert seen == want[:1600]


def test_balanced_writes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(9000).select(F.when(F.col("id") < 8000, "hot").when(F.col("id") < 8990, F.concat(F.lit("s"), (F.col("id") % 9).cast("string"))).alias("source"),
                                  F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_balanced(df, path, "source", F.octet_length("line").cast("bigint"), target_bytes=20_000)
        sinks.write_balanced(df.filter("source = 's1'").withColumn("line", F.lit("new")), path, "source", only=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = [x for x in os.listdir(f"{path}/source=hot") if x.startswith("part-")]
    sizes = [os.path.getsize(f"{path}/source=hot/{x}") for x in files]
    assert len(files) >= 3 and max(sizes) < 0.8 * sum(sizes)  # the hot source is written by several tasks
    want = df.withColumn("line", F.when(F.col("source") == "s1", "new").otherwise(F.col("line")))
    assert rows(spark.read.schema("line string, source string").parquet(path).select("source", "line")) == rows(want)
