"""Helpers shared by the pipeline operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentforge.session import checkpoint_dir

WHITE = " \t\n\x0b\x0c\r"  # the white space that ends a word: \x20 and \x09-\x0D


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver see: ``spark.checkpoint.dir``."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return (conf or checkpoint_dir(spark)).rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/sentforge-{uuid.uuid4().hex}/{what}"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the true
    size of the table, so that it alone decides what to broadcast.
    """
    spark = df.sparkSession
    path = new_folder(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def white_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` as an array (none for null text)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def chain_hash(hashes: Column, n: int) -> Column:
    """Hashes of every run of ``n`` consecutive elements of a long array.

    Runs are combined by doubling, so the work is O(size * log n); the result
    is empty if there are fewer than ``n`` elements.
    """
    out, have, powers = None, 0, {1: hashes}
    k = 1
    while 2 * k <= n:
        powers[2 * k] = _join_runs(powers[k], powers[k], k)
        k *= 2
    for k in sorted(powers, reverse=True):
        while have + k <= n:
            out = powers[k] if out is None else _join_runs(out, powers[k], have)
            have += k
    return out


def _join_runs(left: Column, right: Column, shift: int) -> Column:
    return let(left, lambda a: let(right, lambda b: F.when(
        F.size(b) > shift,
        F.zip_with(
            F.slice(a, 1, F.size(b) - shift),
            F.slice(b, shift + 1, F.size(b) - shift),
            lambda x, y: F.xxhash64(x, y)),
    ).otherwise(F.array().cast("array<bigint>"))))


class Bitmap:
    """A set of 64-bit hashes with false positives only, as a literal of bounded size.

    ``2**low`` to ``2**high`` bits; beyond that more and more values pass, so it
    may only drop rows before an exact join."""

    def __init__(self, hashes: DataFrame, low: int = 14, high: int = 20):
        h = hashes.columns[0]
        n = hashes.count()
        self.longs = 1 << (min(max((16 * n).bit_length(), low), high) - 6)
        slot = F.col(h).bitwiseAND(F.lit(self.longs - 1)).cast("int")
        bit = F.bit_or(F.expr(f"shiftleft(1L, cast(shiftright(`{h}`, 58) & 63 as int))"))
        words = ["0"] * self.longs
        for r in hashes.groupBy(slot.alias("at")).agg(bit.alias("b")).collect():  # at most 2**(high - 6) rows
            words[r["at"]] = str(r["b"])
        self.literal = F.split(F.lit(",".join(words)), ",").cast("array<bigint>")

    def holds(self, h: Column) -> Column:
        word = F.get(self.literal, h.bitwiseAND(F.lit(self.longs - 1)).cast("int"))
        return F.getbit(word, F.shiftright(h, 58).bitwiseAND(F.lit(63)).cast("int")) == 1


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a``, ``b``; any order).

    ``root`` is the smallest node reachable.  Alternating large-star and
    small-star rounds; each keeps the components and the round count grows
    with the logarithm of the component size.  A hub's neighbour list is never
    gathered: its minimum is a partial aggregate and the rest are joins.  Each
    round's table is written to the shared folder, which cuts the lineage.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: neighbours above a node go to the node's minimum
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u != v").distinct())
        large = stage(large, "large")
        # small star: a node and its lower neighbours go to the lowest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        small = stage(small, "small")
        edges = small
        # done when every node points at one root and no root points further
        seen = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("root")).unionByName(
            edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("root")))
        open_nodes = seen.groupBy("n").agg(F.sum("out").alias("out"), F.max("root").alias("root")).filter(
            "out > 1 or (out = 1 and root = 1)")
        if open_nodes.isEmpty():
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
