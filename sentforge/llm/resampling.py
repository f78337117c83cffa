"""Quality by importance resampling.

Two hashed n-gram models - add-one smoothed bucket frequencies of words and
word pairs - are counted: one over the target rows, one over the whole raw
corpus.  A text's log weight is the sum over its n-grams of the log ratio of
both models; the resample takes the ``k`` rows with the largest log weight plus
Gumbel noise, which samples without replacement in proportion to the weights.
The noise comes from a hash of the row, so a re-run gives the same sample.

The target is a bounded sample of labelled rows (``TARGET_ROWS``); the raw
model counts every row.  The ``k``-th largest key is found by narrowing
histograms of fixed size, never by a global sort.

Edge cases: a null or empty text has no n-grams and log weight 0; rows with
equal id and text share their key and are sampled together; without target rows
every log weight is that against a uniform model; an empty table gives none.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import lower_ascii, stage, white_words

BUCKETS = 10_000
TARGET_ROWS = 5_000
KEEP_SHARE = 0.5
_BINS = 1024
_FEW = 4096


def _features(words: Column, buckets: int) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    one = F.transform(words, lambda w: F.xxhash64(w))
    two = F.when(F.size(words) > 1, F.zip_with(
        F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.xxhash64(a, b)))
    return F.transform(F.concat(one, F.coalesce(two, F.array().cast("array<bigint>"))), lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def log_ratios(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               buckets: int = BUCKETS) -> list[float]:
    """Log of target rate over raw rate per bucket (``buckets`` numbers)."""
    ids = target_ids.select(F.col(id_col).alias("_id")).distinct()
    rows = docs.join(ids, docs[id_col] == F.col("_id"), "left").select(
        F.col("_id").isNotNull().cast("int").alias("target"), white_words(lower_ascii(F.col(text_col))).alias("words"))
    counts = rows.select("target", F.explode(_features(F.col("words"), buckets)).alias("b")).groupBy("b").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("target").alias("target")).collect()  # at most ``buckets`` rows
    raw, target = [1.0] * buckets, [1.0] * buckets
    for r in counts:
        raw[r["b"]] += r["raw"]
        target[r["b"]] += r["target"]
    all_raw, all_target = sum(raw), sum(target)
    return [math.log(t / all_target) - math.log(r / all_raw) for t, r in zip(target, raw, strict=True)]


def weigh(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text", seed: int = 29,
          keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``keep`` columns), ``n_grams``, ``log_weight`` and the perturbed ``key``."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)
    d = docs.select(F.struct(*(keep or docs.columns)).alias("row"), (-F.log(-F.log(u))).alias("noise"),
                    white_words(lower_ascii(F.col(text_col))).alias("words"))
    d = d.withColumn("features", _features(F.col("words"), len(ratios)))
    total = F.aggregate("features", F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    return d.select("row", F.size("features").cast("bigint").alias("n_grams"), total.alias("log_weight"), "noise").withColumn(
        "key", F.col("log_weight") + F.col("noise")).drop("noise")


def kth_largest(keys: DataFrame, col: str, k: int) -> float | None:
    """The exact ``k``-th largest value of a double column (None if there are fewer rows).

    Order: NaN, infinity, the finite values, minus infinity; nulls are left out.
    Every round leaves a narrower range of finite values, so it ends on every input."""
    part = keys.select(F.col(col).alias("x")).filter(F.col("x").isNotNull())
    inf = F.lit(math.inf)
    kinds = {r["x"]: r["n"] for r in part.groupBy(
        F.when(F.isnan("x"), 2).when(F.col("x") == inf, 1).when(F.col("x") == -inf, -1).otherwise(0).alias("x")).agg(
            F.count(F.lit(1)).alias("n")).collect()}  # at most four rows
    if k < 1:
        return None
    above = 0
    for kind, value in ((2, math.nan), (1, math.inf)):
        above += kinds.get(kind, 0)
        if k <= above:
            return value
    if k > above + kinds.get(0, 0):
        return -math.inf if k <= above + kinds.get(0, 0) + kinds.get(-1, 0) else None
    low, high = -sys.float_info.max, sys.float_info.max
    while True:
        inside = part.filter((F.col("x") >= low) & (F.col("x") <= high))
        n, least, most = inside.agg(F.count(F.lit(1)), F.min("x"), F.max("x")).first()
        if least == most:
            return least
        if n <= _FEW:
            found = sorted((r["x"] for r in inside.collect()), reverse=True)  # at most _FEW rows
            return found[k - above - 1]
        width = most / _BINS - least / _BINS
        if width == 0 or least + width == least or most - width == most:  # neighbours in floating point: few values
            found = sorted(((r["x"], r["count"]) for r in inside.groupBy("x").count().collect()), reverse=True)
            for x, c in found:
                above += c
                if above >= k:
                    return x
        slot = F.floor(F.greatest(F.least(F.col("x") / width - F.lit(least / width), F.lit(_BINS - 1.0)), F.lit(0.0)))
        bins = inside.groupBy(slot.alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
        if len(bins) < 2:
            raise RuntimeError(f"a range that does not shrink: {least} to {most}")
        for r in sorted(bins, key=lambda r: -r["s"]):
            if above + r["n"] >= k:
                low, high = r["lo"], r["hi"]
                break
            above += r["n"]


def resample(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = KEEP_SHARE,
             keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``n_grams``, ``log_weight``, ``key`` and ``selected`` (the ``share`` of rows sampled)."""
    ratios = log_ratios(docs, target_ids, id_col, text_col)
    weighed = stage(weigh(docs, ratios, id_col, text_col, keep=keep), "weights")
    last = kth_largest(weighed, "key", math.floor(share * weighed.count() + 0.5))
    picked = F.lit(False) if last is None else F.col("key") >= F.lit(last)
    return weighed.select("row.*", "n_grams", "log_weight", "key", picked.alias("selected"))


def target_sample(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", rows: int = TARGET_ROWS) -> DataFrame:
    """Ids of the ``rows`` good rows whose ids hash lowest."""
    good = labels.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("_l")).filter("_l = 1")
    return good.orderBy(F.xxhash64(id_col, F.lit(31)), id_col).select(id_col).limit(rows)
