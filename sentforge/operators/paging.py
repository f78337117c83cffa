"""Exact ranks and pages of a table of any size.

``ranked`` deals the rows to range partitions, counts each, and adds the rows of
the partitions before to the number inside the partition: no task sees more than
its range, and the only window over everything runs on a row per partition.
``page`` reads a page by its rank, ``page_after`` the rows that follow a key
(keyset paging: nothing before the key is sorted or numbered).

Edge cases: nulls sort first; equal rows get neighbouring ranks in no stated
order, so name enough columns; pages beyond the end and empty tables are empty.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentforge.session import staged


def ranked(df: DataFrame, order_by: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with ``name``: the row's place, from 1, in ascending order of the columns."""
    order = [F.col(c).asc_nulls_first() for c in order_by]
    dealt = staged(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = dealt.withColumn("_k", inside).join(starts, "_part")
    return placed.select(*df.columns, (F.col("_before") + F.col("_k")).alias(name))


def page(rows: DataFrame, number: int, size: int, name: str = "rank") -> DataFrame:
    """The rows of page ``number`` (from 1) of a ranked table."""
    return rows.filter((F.col(name) > (number - 1) * size) & (F.col(name) <= number * size))


def _beyond(order_by: Sequence[str], last: Sequence) -> Column:
    """Rows that sort after the key ``last`` (nulls first)."""
    def equal(c, v):
        return F.col(c).isNull() if v is None else F.col(c) == F.lit(v)

    def above(c, v):
        return F.col(c).isNotNull() if v is None else F.coalesce(F.col(c) > F.lit(v), F.lit(False))

    steps = []
    for i, (c, v) in enumerate(zip(order_by, last, strict=True)):
        steps.append(reduce(lambda x, y: x & y, [*[equal(a, b) for a, b in zip(order_by[:i], last[:i], strict=True)], above(c, v)]))
    return reduce(lambda x, y: x | y, steps)


def page_after(df: DataFrame, order_by: Sequence[str], size: int, last: Sequence | None = None) -> DataFrame:
    """The first ``size`` rows, or those after the key ``last`` (the order columns of the page before's last row)."""
    rows = df if last is None else df.filter(_beyond(order_by, last))
    return rows.orderBy(*[F.col(c).asc_nulls_first() for c in order_by]).limit(size)
