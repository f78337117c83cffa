"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of a benchmark item (a shorter item is
one window).  A text contains a window only if it contains every shingle of it,
so one shingle per window - the prefix for full containment - is necessary, and
the rarest one gives the fewest candidates.  Texts are first reduced, inside
each row, to the shingles that occur in some window at all (a bitmap of fixed
size; false positives only cost time); their counts order the shingles by
rarity, a window with a shingle that no text has is dropped, and the join on
the prefix shingle yields candidate places.  Those pass a positional bound
(the window fits between the text's ends) and an exact comparison of words.

Edge cases: null or empty texts and items have no words; an item of fewer words
than a shingle is its own shingle; repeated rows get equal results; a null
``item_id`` counts as the empty string; empty tables give empty results or no
hits.  The columns ``id_col`` and ``text_col`` are the only ones read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentforge.llm.common import Bitmap, chain_hash, lower_ascii, stage

WINDOW = 10
SHINGLE = 5
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAKS), "")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(item, window, len)``, each distinct window of each item, words joined by blanks."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w"))
    n = F.size("w")
    each = F.when(n > window, F.transform(F.sequence(F.lit(1), n - window + 1), lambda i: F.slice("w", i, window))).when(
        n > 0, F.array("w")).otherwise(F.array().cast("array<array<string>>"))
    each = w.select("item", F.explode(each).alias("w"))
    return each.select("item", F.concat_ws(" ", "w").alias("window"), F.size("w").alias("len")).distinct()


def _place(k: int, window: int):
    """A marked shingle with the words around it that any of its windows may take."""
    def place(x: Column) -> Column:
        lo = F.greatest(x["i"] - (window - k), F.lit(0))
        return F.struct(F.lit(k).alias("k"), x["i"].alias("i"), x["h"].alias("h"), lo.alias("lo"),
                        F.slice("w", lo + 1, 2 * window - k).alias("around"))

    return place


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """One row per document row: ``id``, ``th`` (hash of its text), ``n_words``,
    ``n_hit`` (words inside any occurrence of a window) and ``items`` (sorted)."""
    wins = stage(item_windows(items, item_col, item_text, window), "windows")
    distinct = wins.select("window", "len").distinct().withColumn("k", F.least("len", F.lit(shingle)))
    hashes = F.transform(F.split("window", " "), lambda w: F.xxhash64(w))
    of_window = F.lit(None).cast("array<bigint>")
    for k in range(1, shingle + 1):
        of_window = F.when(F.col("k") == k, chain_hash(F.col("hashes"), k)).otherwise(of_window)
    shingles = stage(distinct.withColumn("hashes", hashes).select(
        "window", "len", "k", F.posexplode(of_window).alias("off", "h")), "shingles")
    sizes = sorted(r["k"] for r in shingles.select("k").distinct().collect())  # at most ``shingle`` rows

    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"), words(F.col(text_col)).alias("w"))
    found = F.array().cast("array<struct<k:int,i:int,h:bigint,lo:int,around:array<string>>>")
    if sizes:
        known = Bitmap(shingles.select("h").distinct())
        d = d.withColumn("hashes", F.transform("w", lambda w: F.xxhash64(w)))
        parts = []
        for k in sizes:
            at = F.transform(chain_hash(F.col("hashes"), k), lambda h, i: F.when(known.holds(h), F.struct(i.alias("i"), h.alias("h"))))
            parts.append(F.transform(F.array_compact(at), _place(k, window)))
        found = F.concat(*parts)
    base = stage(d.select("id", "th", F.size("w").cast("bigint").alias("n_words"), found.alias("found")), "found")

    hits = base.filter(F.size("found") > 0).select("id", "th", "n_words", F.explode("found").alias("f")).select("id", "th", "n_words", "f.*")
    counts = stage(hits.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")), "rarity")
    prefix = shingles.join(counts, ["k", "h"], "left").groupBy("window", "len", "k").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "off")).alias("rarest")).filter("rarest.n > 0")
    prefix = stage(prefix.select("k", F.col("rarest.h").alias("h"), F.col("rarest.off").alias("off"), "window", "len"), "prefix")
    start = F.col("i") - F.col("off")
    cand = hits.join(prefix, ["k", "h"]).withColumn("start", start).filter(
        (F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
    spans = stage(cand.filter(F.concat_ws(" ", F.slice("around", F.col("start") - F.col("lo") + 1, F.col("len"))) == F.col("window")).select(
        "id", "th", "start", (F.col("start") + F.col("len")).alias("stop"), "window"), "spans")

    before = F.max("stop").over(Window.partitionBy("id", "th").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1))
    hit = spans.select("id", "th", "start", "stop").distinct().withColumn("before", F.coalesce(before, F.lit(0))).groupBy("id", "th").agg(
        F.sum(F.greatest(F.col("stop") - F.greatest("start", "before"), F.lit(0))).cast("bigint").alias("n_hit"))
    names = spans.select("id", "th", "window").distinct().join(wins.select("window", "item"), "window").groupBy("id", "th").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    both = stage(hit.join(names, hit.id.eqNullSafe(names.id) & (hit.th == names.th)).select(hit.id, hit.th, "n_hit", "items"), "hits")
    b = base.select("id", "th", "n_words")
    return b.join(both, b.id.eqNullSafe(both.id) & (b.th == both.th), "left").select(
        b.id, b.th, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents that hold no benchmark window; same columns as ``docs``."""
    bad = stage(contamination(docs, items, id_col, text_col, **params).filter("n_hit > 0").select(
        F.col("id").alias("_id"), F.col("th").alias("_th")).distinct(), "contaminated")
    same = docs[id_col].eqNullSafe(bad["_id"]) & (F.xxhash64(docs[text_col]) == bad["_th"])
    return docs.join(bad, same, "left_anti")
