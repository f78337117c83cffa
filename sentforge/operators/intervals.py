"""Points in intervals, as equi joins on the nodes of a dyadic tree.

Whole numbers are the leaves of a tree whose node ``(level, place)`` spans
``[place * 2**level, (place + 1) * 2**level)``.  An interval is the disjoint union
of at most two nodes a level; a point lies in an interval exactly if one of the
point's ancestors is one of these nodes, and then only one is.  So a range
condition becomes a join on (keys, level, place), which Spark shuffles, splits
and skew-handles like any other, however many intervals share their keys.

For the *first* interval of every point, each node keeps only its least interval
(a partial aggregate) and each distinct point takes the least of its ancestors:
the work is ``O((points + intervals) * levels)`` even where all intervals overlap.

Edge cases: null keys, points or ends match nothing; an interval whose end lies
before its start is empty; both ends belong to an interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 40  # intervals up to 2**40 long; longer ones are cut into more nodes of the top level

# Points are looked up on the levels that intervals use, which one job finds out; where ``levels`` is given, on all of them.


def covering_nodes(low: Column, high: Column, levels: int = LEVELS) -> Column:
    """The nodes whose disjoint union is ``[low, high]``: an array of structs (level, place)."""
    a, b = low.cast("bigint"), high.cast("bigint") + 1

    def at(level: Column) -> Column:
        first = -F.call_function("shiftright", -a, level)  # the first node of the level that starts in the interval
        end = F.call_function("shiftright", b, level)  # the first one that ends beyond it
        node = lambda place: F.struct(level.cast("int").alias("level"), place.alias("place"))
        odd = lambda x: F.call_function("pmod", x, F.lit(2)) == 1
        edge = F.filter(F.array(F.when((first < end) & odd(first), node(first)), F.when((first < end) & odd(end), node(end - 1))),
                        lambda x: x.isNotNull())
        inner = F.when(first < end, F.transform(F.sequence(first, end - 1), node)).otherwise(F.slice(edge, 1, 0))
        return F.when(level == levels - 1, inner).otherwise(edge)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), at))


def ancestors(point: Column, levels: Sequence[int]) -> Column:
    """The point's nodes on the given levels."""
    at = F.array(*[F.lit(x) for x in levels]).cast("array<int>")
    return F.transform(at, lambda x: F.struct(x.alias("level"), F.call_function("shiftright", point.cast("bigint"), x).alias("place")))


def _nodes(intervals: DataFrame, on: Sequence[str], low: Column, high: Column, keep: Column, levels: int | None) -> DataFrame:
    rows = intervals.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(on)], covering_nodes(low, high, levels or LEVELS).alias("_n"), keep.alias("_v"))
    return rows.select("*", F.explode("_n").alias("_node")).select(*[f"_k{i}" for i in range(len(on))], F.col("_node.level").alias("_level"), F.col("_node.place").alias("_place"), "_v")


def _used(nodes: DataFrame, levels: int | None) -> list[int]:
    return list(range(levels)) if levels else sorted(r["_level"] for r in nodes.select("_level").distinct().collect())  # at most LEVELS numbers


def _probes(points: DataFrame, on: Sequence[str], at: str, used: Sequence[int]) -> DataFrame:
    """Distinct (keys, point) with their nodes: copies of a point are folded before any shuffle."""
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(on)]
    places = points.select(*keys, F.col(at).cast("bigint").alias("_at")).dropna().distinct()
    return places.select("*", F.explode(ancestors(F.col("_at"), used)).alias("_node")).select(
        *[f"_k{i}" for i in range(len(on))], "_at", F.col("_node.level").alias("_level"), F.col("_node.place").alias("_place"))


def first_by_point(points: DataFrame, intervals: DataFrame, on: Sequence[tuple[str, str]], at: str, low: Column, high: Column,
                   order_by: Sequence[str], keep: Sequence[str], name: str = "covering", levels: int | None = None) -> DataFrame:
    """The distinct keys (``_k0`` ...) and points (``_at``) that an interval covers, with the struct ``name`` of ``first_covering``."""
    left, right = [a for a, _ in on], [b for _, b in on]
    least = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], F.struct(*keep).alias("_kept"))
    keys = [f"_k{i}" for i in range(len(on))]
    nodes = _nodes(intervals, right, low, high, least, levels).groupBy(*keys, "_level", "_place").agg(F.min("_v").alias("_v"))
    return _probes(points, left, at, _used(nodes, levels)).join(nodes, [*keys, "_level", "_place"]).groupBy(*keys, "_at").agg(F.min("_v")["_kept"].alias(name))


def first_covering(points: DataFrame, intervals: DataFrame, on: Sequence[tuple[str, str]], at: str, low: Column, high: Column,
                   order_by: Sequence[str], keep: Sequence[str], name: str = "covering", levels: int | None = None) -> DataFrame:
    """``points`` with the struct ``name``: the ``keep`` columns of the first interval, by ``order_by`` (nulls first) and then
    by ``keep``, that covers column ``at``; null where none does.  ``on`` pairs equal columns (points', intervals')."""
    keys = [f"_k{i}" for i in range(len(on))]
    found = first_by_point(points, intervals, on, at, low, high, order_by, keep, name, levels)
    same = F.col(at).cast("bigint") == F.col("_at")
    for (a, _), k in zip(on, keys, strict=True):
        same = same & (F.col(a) == F.col(k))
    return points.join(found, same, "left").drop(*keys, "_at")


def all_covering(points: DataFrame, intervals: DataFrame, on: Sequence[tuple[str, str]], at: str, low: Column, high: Column,
                 keep: Sequence[str], name: str = "covering", levels: int | None = None) -> DataFrame:
    """Every pair of a point and an interval that covers it, once: ``points`` with the struct ``name``."""
    left, right = [a for a, _ in on], [b for _, b in on]
    keys = [f"_k{i}" for i in range(len(on))]
    nodes = _nodes(intervals, right, low, high, F.struct(*keep), levels)
    used = _used(nodes, levels)
    rows = points.select("*", *[F.col(c).alias(k) for c, k in zip(left, keys, strict=True)], F.explode(ancestors(F.col(at), used)).alias("_node"))
    rows = rows.withColumns({"_level": F.col("_node.level"), "_place": F.col("_node.place")}).drop("_node")
    return rows.join(nodes, [*keys, "_level", "_place"]).withColumnRenamed("_v", name).drop(*keys, "_level", "_place")
