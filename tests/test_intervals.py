"""Interval joins against plain comparison."""

import random

import pytest
from pyspark.sql import functions as F

from sentforge.operators import intervals as iv

POINTS = "doc string, page int, at int, level string"
CELLS = "file string, page_no int, low int, high int, rank int, name string"


@pytest.mark.parametrize("levels", [3, 40])
def test_nodes_are_a_disjoint_union(spark, levels):
    r = random.Random(5)
    spans = [(a, a + r.randint(-2, 70)) for a in (r.randint(-80, 80) for _ in range(200))] + [(0, 0), (-1, 0), (-64, 63)]
    df = spark.createDataFrame(spans, "a int, b int").select("a", "b", iv.covering_nodes(F.col("a"), F.col("b"), levels).alias("n"))
    for row in df.collect():
        leaves = sorted(x for n in row.n for x in range(n.place << n.level, (n.place + 1) << n.level))
        assert leaves == list(range(row.a, row.b + 1))
        assert len(row.n) <= (2 * 9 if levels == 40 else 2 * 9 + 80 // 4)


def test_joins_equal_comparison(spark):
    r = random.Random(6)
    points = [(r.choice(["x", "y", None]), r.choice([1, 2, None]), r.choice([None, *range(-40, 60)]), "l") for _ in range(300)] + [("x", 1, 5, "l")] * 40
    cells = [(r.choice(["x", "y", None]), r.choice([1, 2, None]), low, low + r.randint(-3, 50), r.choice([None, 1, 2, 3]), f"c{i}")
             for i, low in enumerate(r.randint(-50, 60) for _ in range(60))] + [("x", 1, None, 9, 1, "null"), ("x", 1, 0, None, 1, "null")]
    p, c = spark.createDataFrame(points, POINTS), spark.createDataFrame(cells, CELLS)
    on = [("doc", "file"), ("page", "page_no")]
    every = iv.all_covering(p, c, on, "at", F.col("low"), F.col("high"), ["name"])
    first = iv.first_covering(p, c, on, "at", F.col("low"), F.col("high"), ["rank"], ["name", "low"])
    assert every.columns == [*p.columns, "covering"] and first.columns == [*p.columns, "covering"]

    def hits(x):
        return [k for k in cells if None not in (*x[:3], *k[:4]) and (k[0], k[1]) == x[:2] and k[2] <= x[2] <= k[3]]

    assert sorted((tuple(x)[:4], x.covering.name) for x in every.collect()) == sorted((x, k[5]) for x in points for k in hits(x))
    want = [(x, min(((k[4] is not None, k[4] or 0, k[5]) for k in hits(x)), default=(0, 0, None))[2]) for x in points]
    assert sorted(map(str, ((tuple(x)[:4], x.covering and x.covering.name) for x in first.collect()))) == sorted(map(str, want))


def test_empty_sides(spark):
    p, c = spark.createDataFrame([("x", 1, 3, "l")], POINTS), spark.createDataFrame([], CELLS)
    on = [("doc", "file"), ("page", "page_no")]
    assert iv.first_covering(p, c, on, "at", F.col("low"), F.col("high"), ["rank"], ["name"]).first().covering is None
    assert iv.all_covering(p, c, on, "at", F.col("low"), F.col("high"), ["name"]).count() == 0
    assert iv.first_covering(p.limit(0), c, on, "at", F.col("low"), F.col("high"), ["rank"], ["name"]).count() == 0


def test_one_page_is_dealt_over_tasks(spark):
    """A million lines and 10,000 overlapping cells on one page: no task gets the page, no pair is formed."""
    n, height = 1_000_000, 200_000
    lines = spark.range(n).select(F.lit("x").alias("doc"), F.lit(1).alias("page"), F.pmod(F.col("id") * 7919, F.lit(height)).cast("int").alias("at"), F.lit("").alias("level"))
    cells = [("x", 1, k * 20, k * 20 + 9_000 + k % 7, k % 5, f"c{k}") for k in range(10_000)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for k, v in zip(old, ("16", "false", "-1"), strict=True):
        spark.conf.set(k, v)
    try:
        out = iv.first_covering(lines, spark.createDataFrame(cells, CELLS), [("doc", "file"), ("page", "page_no")], "at", F.col("low"), F.col("high"), ["rank"], ["name"])
        got = out.groupBy("at").agg(F.first("covering.name").alias("name"), F.count(F.lit(1)).alias("n")).collect()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r.n for r in got) == n and max(sizes) < 3 * n / 16
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    for r in random.Random(7).sample(got, 300):
        near = [c for c in cells[max(0, r.at // 20 - 460):r.at // 20 + 1] if c[2] <= r.at <= c[3]]
        assert r.name == min(((c[4], c[5]) for c in near), default=(0, None))[1]
