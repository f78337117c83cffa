"""Contiguous shards of equal bytes by global prefix sums.

The rows are put into one total order (id, then bytes, checksum and hash of the
text, then the place of the row in the scan), dealt to range partitions, and
summed in two levels: every partition's total, whose running sum gives the
bytes before the partition, and a running sum inside the partition.  A row whose
middle byte lies in the ``j``-th of ``n`` equal parts of all bytes goes to shard
``j``, so each cut is at most half a row away from its target and every shard is
a contiguous stretch of the order.  Only narrow rows are sorted and summed
(unless the caller asks to keep more columns), no task holds more than one range
partition, and the one unpartitioned window runs over a row per partition.

Edge cases: a null text has no bytes and counts ``OVERHEAD``; null ids come
first; repeated rows are placed as often as they occur, next to each other; a
text larger than a whole target leaves some shards empty; an empty table gives
an empty result; other columns are never read unless they are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentforge.llm.common import stage

SHARDS = 24
OVERHEAD = 8  # bytes that a row takes besides its text


def row_bytes(text: Column, overhead: int = OVERHEAD) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(overhead)).cast("bigint")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def _part_of(at: Column, whole: Column, parts: int) -> Column:
    """Which of ``parts`` equal parts of ``[0, whole)`` holds ``at`` (whole numbers only)."""
    return F.call_function("div", at * F.lit(parts), whole).cast("int")


def byte_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", overhead: int = OVERHEAD,
                keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``keep`` columns), ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    rows = docs.select(
        F.struct(*(keep or docs.columns)).alias("row"), F.col(id_col).alias("id"), row_bytes(F.col(text_col), overhead).alias("size"),
        text_crc32(F.col(text_col)).alias("crc"), F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("tie"))
    order = ["id", "size", "crc", "h", "tie"]
    # written first, so that the tie-break stays the same when tasks are run again
    dealt = stage(rows, "rows").repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    dealt = stage(dealt.withColumn("part", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    starts = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
    whole = totals.agg(F.coalesce(F.sum("bytes"), F.lit(0))).scalar()
    inside = Window.partitionBy("part").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = dealt.select(
        "part", "row", "size", "crc", F.row_number().over(inside).alias("k"),
        F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("b"))
    middle = 2 * (F.col("bytes_before") + F.col("b")) + F.col("size")
    placed = stage(placed.join(starts, "part").select(
        "row", "size", "crc", (F.col("rows_before") + F.col("k") - 1).alias("place"),
        _part_of(middle, 2 * whole, shards).alias("shard")), "placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # a row per shard
    return placed.join(first, "shard").select(
        "row", "size", F.col("crc").alias("text_crc32"), "shard", (F.col("place") - F.col("first")).alias("slot"))


def write_shards(sharded: DataFrame, path: str, by: str = "_shard") -> None:
    """One folder per shard (``by=0``, ...; no column of the rows may have that name), rows in slot order over its
    files; a large shard is written by several tasks."""
    rows = sharded.select("row.*", F.col("shard").alias(by), F.col("slot").alias(f"{by}_slot"))
    at = [by, f"{by}_slot"]
    rows.repartitionByRange(*at).sortWithinPartitions(*at).write.partitionBy(by).parquet(path)
