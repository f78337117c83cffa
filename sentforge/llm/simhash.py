"""SimHash near-duplicate groups found through pivot distance tables.

Fingerprints that lie within ``max_bits`` of each other have, for *every*
reference fingerprint (pivot), distances that differ by at most ``max_bits``.
The bits are cut into segments; two linked fingerprints agree on all but
``max_bits`` segments, so on those segments' bits their distances to every
pivot are equal (coordinate difference zero).  That vector of restricted
distances is the equi-join key; pairs it proposes are then discarded when any
full-width coordinate differs by more than ``max_bits``, and the survivors are
verified by their exact Hamming distance.

Edge cases: a null text has no words; a text without words has fingerprint
zero and links like any other; fewer words than a shingle make one shingle of
the whole sequence; repeated rows and equal texts share a fingerprint and a
component; a null ``doc_id`` is carried through and never the smallest unless
the whole component has none (then ``component_id`` is null).
"""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import connected_components, stage

SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 4  # pairs agree on SEGMENTS - MAX_BITS of them
KEY_PIVOTS = 10  # restricted distances packed into one long key, 6 bits each
TABLE_PIVOTS = 8  # full-width distances packed into one long, 8 bits each

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles (majority of XXH64 bits)."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    buf = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:n].tolist()
    ends = ends[shingle - 1:].tolist() if len(words) >= shingle else [len(buf)]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.fromiter(
            (digest(buf[s:e], 42) for s, e in zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK], strict=True)),
            ">u8", min(_CHUNK, n - at))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id_col, fp)`` with the signed 64-bit fingerprint of every row's whole text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def compute(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fps, np.uint64).astype(np.int64))], names=["id", "fp"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"id {kind}, fp bigint").select(F.col("id").alias(id_col), "fp")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _packed_distances(fp: Column, pivots: list[int], mask: int, bits: int) -> Column:
    out = F.lit(0).cast("bigint")
    for k, p in enumerate(pivots):
        d = F.bit_count(fp.bitwiseXOR(F.lit(_signed(p))).bitwiseAND(F.lit(_signed(mask))))
        out = out.bitwiseOR(F.shiftleft(d.cast("bigint"), bits * k))
    return out


def hamming_links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, seed: int = 7) -> DataFrame:
    """Pairs ``(a, b)``, ``a < b``, of the distinct values in ``fps.fp`` within ``max_bits`` bits."""
    rnd = random.Random(seed)
    edges = [64 * i // segments for i in range(segments + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:], strict=False)]
    masks = [sum(c) for c in combinations(parts, segments - max_bits)]
    key_pivots = [rnd.getrandbits(64) for _ in range(KEY_PIVOTS)]
    table_pivots = [rnd.getrandbits(64) for _ in range(TABLE_PIVOTS)]
    rows = fps.select("fp", _packed_distances(F.col("fp"), table_pivots, (1 << 64) - 1, 8).alias("far"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), _packed_distances(F.col("fp"), key_pivots, m, 6).alias("near"))
        for i, m in enumerate(masks)])).alias("k")).select("fp", "far", "k.part", "k.near")
    rows = stage(rows, "pivot-tables")
    a, b = rows.alias("a"), rows.alias("b")
    within = F.lit(True)
    for k in range(TABLE_PIVOTS):
        at = [F.shiftright(F.col(f"{s}.far"), 8 * k).bitwiseAND(F.lit(255)) for s in "ab"]
        within = within & (F.abs(at[0] - at[1]) <= max_bits)
    same = (F.col("a.part") == F.col("b.part")) & (F.col("a.near") == F.col("b.near")) & (F.col("a.fp") < F.col("b.fp"))
    exact = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    return a.join(b, same & within & exact).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")).distinct()


def near_duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
    max_bits: int = MAX_BITS, segments: int = SEGMENTS,
) -> DataFrame:
    """One row per input row: ``id_col``, ``fp``, ``root`` (the component's smallest
    signed fingerprint) and ``component_id`` (its smallest id)."""
    fps = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    roots = connected_components(hamming_links(distinct, max_bits, segments))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(rooted.join(low, "root").select("fp", "root", "component_id"), "classes")
    return fps.join(classes, "fp").select(id_col, "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents without all but one of each component: the row with the
    smallest id stays; of several such rows (repeated or null ids) the first in
    the order of all their columns.  Same columns as ``docs``."""
    groups = stage(near_duplicate_groups(docs, id_col, text_col, **params), "groups")
    ids = groups.groupBy(F.col(id_col).alias("_id")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.col(id_col).eqNullSafe(F.col("component_id"))).alias("_keep")).filter("_keep")
    once = ids.filter("_rows = 1 and _id is not null").select("_id")
    kept = docs.join(once, docs[id_col] == F.col("_id"), "left_semi")
    unclear = stage(ids.filter("_rows > 1 or _id is null").select("_id"), "unclear")
    if unclear.isEmpty():
        return kept
    rows = docs.withColumn("_row", F.struct(*docs.columns)).join(
        unclear, docs[id_col].eqNullSafe(F.col("_id")), "left_semi").select(F.col("_row"), F.col(text_col).alias("_text"))
    rows = fingerprints(rows, "_row", "_text", params.get("shingle", SHINGLE)).join(
        groups.select("fp", "root", "component_id").distinct(), "fp")
    rows = rows.filter(F.col(f"_row.{id_col}").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("_row").alias("_row"))
    return kept.unionByName(rows.select("_row.*"))
