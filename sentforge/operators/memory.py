"""Keyed translation memory and keyed document updates, as batch joins.

The reference looks each sentence up in a key-value store from inside a row
map (one remote call per row, repeated on every action).  Here the memory is a
table keyed by ``<target language>_<sha-256(source)>`` and every step is a
join: requests are deduplicated first, lookups are one left join, misses a
left-anti join, and write-back an upsert producing a new table version (write
it to a new path; never overwrite the path being read).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.functions.text import memory_key

MEMORY_COLUMNS = ("key", "source_sentence", "target_sentence", "source_language", "target_language")


def memory_rows(
    sources: DataFrame, targets: Column, source_language: Column, target_language: Column, text_col: str = "sentence", unique: bool = True
) -> DataFrame:
    """Build memory rows (one per key) from sentences and their translations.

    Rows for a store, which picks a row per key itself, need not be ``unique``: that saves shuffling them twice."""
    rows = sources.select(
        memory_key(target_language, F.col(text_col)).alias("key"),
        F.col(text_col).alias("source_sentence"),
        targets.alias("target_sentence"),
        source_language.alias("source_language"),
        target_language.alias("target_language"),
    )
    return dedupe_by_key(rows) if unique else rows


def dedupe_by_key(rows: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per key: the last in ``order_col`` wins (NULL order comes first);
    without it, or on equal order, the largest (target, source, languages)
    struct.  ``max`` is one partial aggregation (no per-key list)."""
    payload = F.struct("target_sentence", "source_sentence", "source_language", "target_language")
    order = [F.col(order_col).alias("_o")] if order_col else []
    return rows.groupBy("key").agg(F.max(F.struct(*order, payload.alias("_p"))).alias("_m")).select("key", "_m._p.*").select(*MEMORY_COLUMNS)


def _keyed_requests(requests: DataFrame, target_language: str, text_col: str) -> DataFrame:
    """Distinct non-NULL requests with their memory key.  The dedupe runs as
    a partial aggregation first, so a request repeated in a large share of
    the rows collapses map-side before any shuffle."""
    r = requests.select(F.col(text_col).alias("source_sentence")).filter(F.col("source_sentence").isNotNull())
    return r.distinct().withColumn("key", memory_key(F.lit(target_language), F.col("source_sentence")))


def memory_lookup(
    requests: DataFrame, memory: DataFrame, target_language: str, text_col: str = "sentence"
) -> DataFrame:
    """Distinct requests with ``target_sentence`` and ``hit``.  A missing key,
    NULL or empty stored text is a miss (``target_sentence`` NULL)."""
    r = _keyed_requests(requests, target_language, text_col)
    m = memory.select("key", F.col("target_sentence").alias("_t")).filter(F.col("_t").isNotNull() & (F.col("_t") != ""))
    j = r.join(m, "key", "left")
    return j.select("source_sentence", F.col("_t").alias("target_sentence"), F.col("_t").isNotNull().alias("hit"))


def memory_misses(
    requests: DataFrame, memory: DataFrame, target_language: str, text_col: str = "sentence"
) -> DataFrame:
    """Distinct requests without a usable translation (left-anti join)."""
    r = _keyed_requests(requests, target_language, text_col)
    m = memory.filter(F.col("target_sentence").isNotNull() & (F.col("target_sentence") != "")).select("key")
    return r.join(m, "key", "left_anti").select("source_sentence")


def memory_upsert(memory: DataFrame, new_rows: DataFrame, order_col: str | None = None) -> DataFrame:
    """New memory version: rows of ``new_rows`` replace rows with the same key,
    other rows are kept; of several new rows the last in ``order_col`` is
    written (see ``dedupe_by_key``).  Idempotent."""
    new = dedupe_by_key(new_rows, order_col)
    kept = memory.select(*MEMORY_COLUMNS).join(new.select("key"), "key", "left_anti")
    return kept.unionByName(new)


def keyed_merge(base: DataFrame, updates: DataFrame, key: str, fields: Sequence[str] | None = None,
                order_col: str | None = None) -> DataFrame:
    """Append-with-update: keys present in both take each given (non-NULL)
    update field over the stored one (``replaceDocument=false``); other keys
    from either side pass through.  Several updates of a key are applied field by
    field: the last non-NULL value in ``order_col`` wins (without it the largest).
    One full outer join on the key.
    ``key`` may be a nested field such as ``_id.oid``; it is returned as a
    top-level column named after its last part."""
    name = key.split(".")[-1]
    fields = list(fields) if fields is not None else [c for c in base.columns if c != key.split(".")[0]]
    b = base.select(F.col(key).alias(name), *[F.col(f).alias("b_" + f) for f in fields])
    u_fields = [f for f in fields if f in updates.columns]
    last = (lambda f: F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order_col)))) if order_col else F.max
    u = updates.groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias("_n"), *[last(f).alias("u_" + f) for f in u_fields]).drop("_n")
    j = b.join(u, name, "full_outer")
    out = [F.col(name)]
    for f in fields:
        out.append(F.coalesce(F.col("u_" + f), F.col("b_" + f)).alias(f) if f in u_fields else F.col("b_" + f).alias(f))
    return j.select(*out)


def _first_match_hit(df: DataFrame, predicate: Column, order_key: str) -> Column:
    """True on the first row matching ``predicate`` in ``order_key`` order.
    ``order_key`` must be unique: all rows tied on the first key are touched.
    The first key is a scalar subquery over one tiny global aggregate
    (partial per partition) - never a global window or a cross join."""
    first = df.filter(predicate).agg(F.min(order_key).alias("_first")).scalar()
    return F.coalesce(first.isNotNull() & (F.col(order_key) == first), F.lit(False))


def predicate_update(df: DataFrame, predicate: Column, column: str, value, order_key: str) -> DataFrame:
    """``$set`` one column on the first row matching ``predicate``."""
    hit = _first_match_hit(df, predicate, order_key)
    return df.select(*[F.when(hit, F.lit(value)).otherwise(F.col(c)).alias(c) if c == column else F.col(c)
                       for c in df.columns])


def predicate_delete(df: DataFrame, predicate: Column, order_key: str) -> DataFrame:
    """Remove the first row matching ``predicate``."""
    return df.filter(~_first_match_hit(df, predicate, order_key))


def predicate_find(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(predicate)
