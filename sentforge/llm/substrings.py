"""Exact substring dedup: every byte inside a ``length``-byte string that starts earlier too.

1. *Scan.* Windows of ``length`` bytes are grouped by their anchor, the bytes of
   least hash inside, so equal windows meet under equal anchors and only one
   record per run of windows (some 30 bytes of text) is shuffled.  Copies inside
   a chunk are settled there; of equal blocks only a chunk's first travels, so a
   passage in a third of all texts sends one record per chunk.
2. *Blocks.* Records meet by anchor: of equal blocks all but the first go whole.
   An anchor with different blocks (the edges of copies, near copies) is a
   candidate: its blocks' bytes are fetched from their texts.
3. *Windows.* Candidate blocks are concatenated in small batches.  From their
   suffix order comes the Burrows-Wheeler transform; breadth-first backward
   extension of its intervals derives the common-prefix values 1, 2, 3, ... and
   stops at ``length``: neighbours whose value is still open then share a whole
   window.  A group of blocks too large for a batch is halved by window offset,
   with the bytes that all windows of a half contain as its finer key: in its task
   up to ``HELD`` bytes, above that by shuffles on the finer keys, where of equal
   parts of blocks all but the first go whole.  Windows of a single offset are
   equal, so no transform sees more than a batch.

The order is (``doc_id``, start); windows are judged on the input and never cross
texts.  Edge cases: null texts are empty; a null id is the smallest; rows of one
id count as one document, and equal starts in them are not earlier; texts below
``length`` bytes keep everything; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import let, stage

MIN_BYTES = 100
GRAM = 32  # bytes of an anchor
CHUNK = 1 << 21  # bytes hashed at a time; positions take 21 bits
BATCH = 1 << 17  # bytes under one Burrows-Wheeler transform
HELD = 1 << 22  # bytes of one group that a task may hold
RECORD = np.dtype([("anchor", "<u8"), ("block", "<u8"), ("id", "<i8"), ("start", "<i4"), ("doc", "<u2"), ("left", "u1"), ("span", "u1")])
_PLACE = np.uint64(CHUNK - 1)
_RNG = np.random.default_rng(101)
_BYTES = _RNG.integers(0, 1 << 64, (2, 256), np.uint64)
_ODD = _RNG.integers(0, 1 << 64, 8, np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _ODD[6]
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes (a power of two) from every position."""
    h, have, k = _BYTES[0][data], 1, 0
    while have < n:
        h = h[:-have] * _ODD[k] + h[have:]
        h ^= h >> np.uint64(31)
        have, k = 2 * have, k + 1
    return _mix(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (width - have)], x[width - have:]) if width > have else x


def runs(data: np.ndarray, owner_end: np.ndarray, owner: np.ndarray, length: int = MIN_BYTES):
    """Windows of ``length`` bytes grouped by their anchor.

    The anchor of a window is its ``GRAM`` bytes of least hash (the leftmost of
    several), so equal windows have equal anchors at equal places.  ``data`` holds
    texts end to end; ``owner_end``: where each ends.  Returns ``(first, last,
    anchor, hash)`` of the runs of consecutive windows with one anchor."""
    width = length - GRAM + 1
    if len(data) < length:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64)
    h = gram_hashes(data, GRAM)
    keys = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    at = (_sliding_min(keys, width) & _PLACE).astype(np.int64)
    starts = np.arange(len(at))
    whole = owner_end[owner[:len(at)]] - starts >= length
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | ~whole[:-1]
    first = np.flatnonzero(new & whole)
    # a run ends before the next start of a run, or of a window that leaves its text
    edges = np.flatnonzero(new | ~whole)
    nxt = np.searchsorted(edges, first, side="right")
    last = np.append(edges, len(at))[nxt] - 1
    return first, last, at[first], h[at[first]]


_powers: list[np.ndarray] = []


def block_hashes(data: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Polynomial hash (modulo 2**64, random byte values) of ``data[first:stop]`` for each pair."""
    if not _powers:
        base, n = int(_ODD[7]), 1 << 64
        for b in (base, pow(base, -1, n)):
            p = np.full(CHUNK + 1, b, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[1][data] * _powers[0][:len(data)], dtype=np.uint64)])
    return _mix((sums[stop] - sums[first]) * _powers[1][first])


def _as_id(column: pa.Array) -> np.ndarray:
    """Integer ids; null becomes the smallest."""
    return column.cast(pa.int64()).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)


def _chunks(batches, length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Chunks of at most ``CHUNK`` bytes: their bytes and the texts in them as
    ``(id, th, offset in the text, size)``, ordered by id.  A longer text is cut
    into pieces that overlap by all but one byte of a window."""
    held: list[tuple[int, int, int, bytes]] = []
    size = 0

    def out():
        held.sort(key=lambda x: (x[0], x[1], x[2]))
        return np.frombuffer(b"".join(x[3] for x in held), np.uint8), [(i, t, o, len(x)) for i, t, o, x in held]

    for b in batches:
        ids, hashes = _as_id(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
        for i, t, text in zip(ids.tolist(), hashes.tolist(), b.column(2).to_pylist(), strict=True):
            data = (text or "").encode("utf-8", "surrogatepass")
            if len(data) < length:
                continue
            step = CHUNK - length + 1
            for at in range(0, max(1, len(data) - length + 1), step):
                piece = data[at:at + CHUNK]
                if held and (size + len(piece) > CHUNK or len(held) == 1 << 16):
                    yield out()
                    held, size = [], 0
                held.append((i, t, at, piece))
                size += len(piece)
    if held:
        yield out()


def _firsts(r: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of records in an order that puts equal blocks together, earliest first:
    where a block is new, and which records repeat one that starts earlier."""
    s = r[order]
    new = np.ones(len(s), bool)
    same = s[1:] if len(s) else s
    new[1:] = ~((same["anchor"] == s[:-1]["anchor"]) & (same["block"] == s[:-1]["block"])
                & (same["left"] == s[:-1]["left"]) & (same["span"] == s[:-1]["span"]))
    lead = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    later = (s["id"] != s["id"][lead]) | (s["start"] != s["start"][lead])
    return new, later & ~new


def _order(r: np.ndarray) -> np.ndarray:
    return np.lexsort((r["start"], r["id"], r["span"], r["left"], r["block"], r["anchor"]))


OUT = "kind string, chunk bigint, doc int, id bigint, th bigint, start bigint, stop bigint, anchor bigint, left int"
SENT = "bucket int, chunk bigint, kind string, blob binary"


def _rows(kind: str, n: int, **cols) -> pa.RecordBatch:
    kinds = {"chunk": pa.int64(), "doc": pa.int32(), "id": pa.int64(), "th": pa.int64(), "start": pa.int64(), "stop": pa.int64(),
             "anchor": pa.int64(), "left": pa.int32()}
    full = {k: pa.array(np.asarray(cols[k]), t) if k in cols else pa.nulls(n, t) for k, t in kinds.items()}
    return pa.RecordBatch.from_arrays([pa.array([kind] * n, pa.string()), *full.values()], names=["kind", *full])


def _scan(length: int, buckets: int):
    def run(batches):
        for data, texts in _chunks(batches, length):
            sizes = np.array([t[3] for t in texts])
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(texts)), sizes)
            first, last, anchor, h = runs(data, ends, owner, length)
            doc = owner[first] if len(first) else first
            begin = (ends - sizes)[doc]
            offset = np.array([t[2] for t in texts], np.int64)[doc]
            r = np.empty(len(first), RECORD)
            r["anchor"], r["block"] = h, block_hashes(data, first, last + length)
            r["id"] = np.array([t[0] for t in texts], np.int64)[doc]
            r["start"], r["doc"], r["left"], r["span"] = first - begin + offset, doc, anchor - first, last - first
            chunk = int.from_bytes(hashlib.blake2b(repr([t[:3] for t in texts]).encode(), digest_size=8).digest(), "little", signed=True)
            order = _order(r)
            new, again = _firsts(r, order)
            r = r[order]
            table = np.array([(i, t) for i, t, _, _ in texts], np.int64)
            out = [(chunk % buckets, "docs", table.tobytes())]
            if again.any():
                out.append((chunk % buckets, "again", r[again].tobytes()))
            # of rows with one id and start (repeated rows) each is sent
            sent = r[~again]
            to = (sent["anchor"] % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[by], np.arange(buckets + 1))
            out += [(k, "runs", sent[by[lo:hi]].tobytes()) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if hi > lo]
            cols = [list(c) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array([chunk] * len(out), pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.binary())], names=["bucket", "chunk", "kind", "blob"])

    return run


def _meet(length: int):
    """Settle the records of each bucket (rows come sorted by bucket)."""
    def settle(held: list[tuple[int, bytes]]):
        r = np.concatenate([np.frombuffer(b, RECORD) for _, b in held])
        chunk = np.repeat(np.array([c for c, _ in held], np.int64), [len(b) // RECORD.itemsize for _, b in held])
        order = _order(r)
        new, again = _firsts(r, order)
        s, c = r[order], chunk[order]
        if again.any():
            x = s[again]
            yield _rows("gone", len(x), chunk=c[again], doc=x["doc"].astype(np.int32), start=x["start"].astype(np.int64),
                        stop=x["start"].astype(np.int64) + x["span"] + length)
        # different blocks under one anchor; repeated rows of one start are all looked at
        lone = np.ones(len(s), bool)
        group = np.cumsum(np.concatenate([[True], s["anchor"][1:] != s["anchor"][:-1]])) - 1
        lone = np.bincount(group, weights=new)[group] < 2
        pick = ~lone & ~again
        if pick.any():
            x = s[pick]
            yield _rows("candidate", len(x), chunk=c[pick], doc=x["doc"].astype(np.int32), start=x["start"].astype(np.int64),
                        stop=x["start"].astype(np.int64) + x["span"] + length, anchor=x["anchor"].view(np.int64), left=x["left"].astype(np.int32))

    def run(batches):
        at, held = None, []
        for b in batches:
            for bucket, chunk, kind, blob in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == "docs":
                    t = np.frombuffer(blob, np.int64).reshape(-1, 2)
                    yield _rows("doc", len(t), chunk=np.full(len(t), chunk), doc=np.arange(len(t), dtype=np.int32), id=t[:, 0], th=t[:, 1])
                elif kind == "again":
                    x = np.frombuffer(blob, RECORD)
                    yield _rows("gone", len(x), chunk=np.full(len(x), chunk), doc=x["doc"].astype(np.int32), start=x["start"].astype(np.int64),
                                stop=x["start"].astype(np.int64) + x["span"] + length)
                else:
                    if held and bucket != at:
                        yield from settle(held)
                        held = []
                    at = bucket
                    held.append((chunk, blob))
        if held:
            yield from settle(held)

    return run


def common_prefix_cuts(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order (to ``length`` at least) and the cuts where neighbours share less than ``length``.

    ``text`` ends with symbol 0, which separates its parts; no string across it
    is followed.  Cuts come from breadth-first backward extension: the interval of
    all suffixes that begin with a string w gives, for each symbol c before w,
    that of cw, whose upper end is a cut of value one more.  After ``length``
    rounds the places without a cut are common prefixes of at least ``length``."""
    n = len(text)
    symbols, code = np.unique(text, return_inverse=True)
    sigma = len(symbols)
    rank, have = code.astype(np.int64) + 1, 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-have or None] = rank[have:] if have < n else 0
        key = rank * (n + sigma + 2) + ahead
        order = np.argsort(key)  # ties share more than ``have`` symbols: their order is free
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], sorted_key[1:] != sorted_key[:-1]]))
        have *= 2
        if have >= length or rank[order[-1]] == n or have >= n:
            break
    before = code[order - 1]  # the transform; the first suffix is preceded by the last symbol
    occ = np.zeros((n + 1, sigma), np.int32)
    occ[np.arange(1, n + 1), before] = 1
    np.cumsum(occ, axis=0, out=occ)
    total = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=sigma))])
    cut = np.zeros(n + 1, bool)
    cut[0] = cut[n] = True
    low, high = total[1:-1].copy(), total[2:].copy()  # the intervals of single symbols
    cut[total] = True
    for _ in range(length - 1):
        if not len(low):
            break
        down, up = occ[low], occ[high]
        which, c = np.nonzero(up[:, 1:] > down[:, 1:])
        c += 1
        new_low = total[c] + down[which, c]
        new_high = total[c] + up[which, c]
        # an end seen before belongs to a shorter common prefix: its interval was extended then
        fresh = ~cut[new_high]
        new_low, new_high = new_low[fresh], new_high[fresh]
        cut[new_high] = True
        low, high = new_low, new_high
    return order, cut[:n]


class Blocks:
    """Blocks of one or more anchors: ``id``, ``th``, ``start``, ``left`` (bytes before the anchor) and their bytes."""

    def __init__(self, length: int):
        self.length, self.rows, self.size = length, [], 0

    def add(self, rows: list[tuple[int, int, int, int, bytes]]) -> None:
        self.rows += rows
        self.size += sum(len(r[4]) + 1 for r in rows)

    def settle(self) -> Iterator[tuple[int, int, int, int]]:
        """``(id, th, start, stop)``: stretches of windows that start earlier elsewhere."""
        if not self.rows:
            return
        n = self.length
        sizes = np.array([len(r[4]) for r in self.rows])
        text = np.frombuffer(b"".join(r[4] + b"\0" for r in self.rows), np.uint8).astype(np.uint16) + 1
        ends = np.cumsum(sizes + 1) - 1
        text[ends] = 0
        order, cut = common_prefix_cuts(text, n)
        piece = np.repeat(np.arange(len(sizes)), sizes + 1)
        whole = ends[piece] - np.arange(len(text)) >= n
        kind = np.empty(len(text), np.int64)
        kind[order] = np.cumsum(cut)
        at = np.flatnonzero(whole)
        ids = np.array([r[0] for r in self.rows], np.int64)[piece[at]]
        starts = np.array([r[2] for r in self.rows], np.int64)[piece[at]] + at - (ends - sizes)[piece[at]]
        by = np.lexsort((starts, ids, kind[at]))
        lead = np.ones(len(by), bool)
        lead[1:] = kind[at][by][1:] != kind[at][by][:-1]
        lead = np.maximum.accumulate(np.where(lead, np.arange(len(by)), 0))
        later = (ids[by] != ids[by][lead]) | (starts[by] != starts[by][lead])
        gone = np.zeros(len(text) + 1, bool)
        gone[at[by[later]]] = True
        first = np.flatnonzero(gone[:-1] & ~np.concatenate([[False], gone[:-2]]))
        last = np.flatnonzero(gone[:-1] & ~gone[1:])
        for a, b in zip(first.tolist(), last.tolist(), strict=True):  # a stretch ends with its block's last window
            i, th, start, _, _ = self.rows[piece[a]]
            o = a - int(ends[piece[a]] - sizes[piece[a]])
            yield i, th, start + o, start + o + (b - a) + n


def _halves(rows: list[tuple], length: int, low: int, high: int, limit: int) -> Iterator[list[tuple]]:
    """Groups of at most ``limit`` bytes (or of single window offsets: equal windows) that hold all equal
    windows together; ``low`` to ``high``: bytes before the anchor in the windows."""
    if low == high or sum(len(r[4]) + 1 for r in rows) <= limit:
        yield rows
        return
    middle = (low + high) // 2
    for lo, hi in ((low, middle), (middle + 1, high)):
        groups: dict[bytes, list[tuple]] = {}
        for i, th, start, left, data in rows:
            a, b = max(0, left - hi), min(len(data) - length, left - lo)  # first and last window
            if a <= b:
                key = data[left - lo:left + length - hi]
                groups.setdefault(key, []).append((i, th, start + a, left - a, data[a:b + length]))
        for g in groups.values():
            if len(g) > 1:
                yield from _halves(g, length, lo, hi, limit)


def _windows(length: int, limit: int = BATCH):
    """Settle candidate blocks; rows come sorted by anchor and place."""
    def run(batches):
        def done(found):
            found = list(found)
            if found:
                cols = [list(c) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "th", "start", "stop"])

        batch, at, group = Blocks(length), None, []

        def close():
            nonlocal batch
            if len(group) > 1:
                for part in _halves(group, length, 0, length - GRAM, limit):
                    size = sum(len(r[4]) + 1 for r in part)
                    if size > limit:  # windows of a single offset are equal
                        lead = min((i, start) for i, _, start, _, _ in part)
                        yield from done((i, th, start, start + length) for i, th, start, _, _ in part if (i, start) != lead)
                        continue
                    if batch.size + size > limit:
                        yield from done(batch.settle())
                        batch = Blocks(length)
                    batch.add(part)

        for b in batches:
            for anchor, i, th, start, left, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if anchor != at:
                    yield from close()
                    at, group = anchor, []
                if not group or group[-1] != (i, th, start, left, data):  # a repeated row
                    group.append((i, th, start, left, data))
        yield from close()
        yield from done(batch.settle())

    return run


SPAN = "id bigint, th bigint, start bigint, stop bigint"


def _settled(blocks: DataFrame, length: int) -> DataFrame:
    return blocks.repartition("anchor").sortWithinPartitions("anchor", "id", "th", "start").select(
        "anchor", "id", "th", "start", "left", "data").mapInArrow(_windows(length), SPAN)


def _halved(blocks: DataFrame, length: int, held: int) -> DataFrame:
    """The spans of `_windows` for groups above ``held`` bytes, which no task gathers.

    Rounds of halving by window offset.  The bytes that all windows of a half
    contain, under the group's key, are its finer key (``anchor``, hashed: it only
    brings blocks together).  Of equal parts of blocks, found by a partial
    aggregate and a join on their bytes, all but the first go whole; groups that
    now fit are settled by `_windows`, the others are halved again."""
    rows, out = blocks.withColumn("low", F.lit(0)).withColumn("high", F.lit(length - GRAM)), []
    while True:
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        half = lambda lo, hi: F.struct(
            lo.alias("low"), hi.alias("high"), F.greatest(F.lit(0), F.col("left") - hi).alias("a"),
            F.least(F.length("data") - length, F.col("left") - lo).alias("b"))  # first and last window
        rows = rows.withColumn("h", F.explode(F.array(half(F.col("low"), middle), half(middle + 1, F.col("high"))))).filter("h.a <= h.b")
        key = F.expr(f"substring(data, left - h.low + 1, {length} - (h.high - h.low))")
        rows = rows.select(
            F.xxhash64("anchor", "h.low", key).alias("anchor"), "id", "th", (F.col("start") + F.col("h.a")).alias("start"),
            (F.col("left") - F.col("h.a")).alias("left"), F.expr(f"substring(data, h.a + 1, h.b - h.a + {length})").alias("data"), "h.low", "h.high")
        same = ["anchor", "left", "data"]
        leads = stage(rows.groupBy(same).agg(F.min(F.struct("id", "start")).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "leads")
        rows = stage(rows.join(leads, same, "left").withColumn(
            "again", F.coalesce(F.struct("id", "start") != F.col("lead"), F.lit(False))).drop("lead"), "halves")
        out.append(rows.filter("again").select("id", "th", "start", (F.col("start") + F.length("data")).alias("stop")))
        # what is left of a single offset has no equal that starts earlier
        rows = rows.filter("not again and low < high").drop("again")
        sizes = stage(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("data") + 1).alias("size")).filter("n > 1"), "sizes")
        rows = rows.join(sizes.drop("n"), "anchor")
        out.append(_settled(rows.filter(F.col("size") <= held), length))
        rows = rows.filter(F.col("size") > held).drop("size")
        if sizes.filter(F.col("size") > held).isEmpty():
            return reduce(DataFrame.unionByName, out)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_BYTES) -> DataFrame:
    """``(id, th, spans)``: per text the sorted ``(start, stop)`` byte stretches, not
    yet merged, that start earlier elsewhere; null ids show as the smallest integer."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    buckets = max(64, 4 * docs.rdd.getNumPartitions())
    sent = texts.mapInArrow(_scan(length, buckets), SENT).repartition("bucket").sortWithinPartitions("bucket")
    met = stage(sent.mapInArrow(_meet(length), OUT), "met")
    names = met.filter("kind = 'doc'").select("chunk", "doc", "id", "th")
    gone = met.filter("kind = 'gone'").groupBy("chunk", "doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).join(
        names, ["chunk", "doc"]).select("id", "th", F.explode("spans").alias("s")).select("id", "th", "s.*")
    wanted = met.filter("kind = 'candidate'").groupBy("chunk", "doc").agg(
        F.collect_list(F.struct("anchor", "start", "stop", "left")).alias("blocks")).join(names, ["chunk", "doc"]).select(
        F.col("id").alias("_id"), F.col("th").alias("_th"), "blocks")
    data = F.encode("text", "UTF-8")
    fetched = texts.withColumn("id", F.coalesce("id", F.lit(-(1 << 63))))
    fetched = fetched.join(wanted, (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th")))
    blocks = fetched.select("id", "th", F.explode(let(data, lambda d: F.transform("blocks", lambda b: F.struct(
        b["anchor"].alias("anchor"), b["start"].alias("start"), b["left"].alias("left"),
        F.substring(d, (b["start"] + 1).cast("int"), (b["stop"] - b["start"]).cast("int")).alias("data"))))).alias("b"))
    blocks = blocks.select("b.anchor", "id", "th", "b.start", "b.left", "b.data")
    large = stage(met.filter("kind = 'candidate'").groupBy("anchor").agg(F.sum(F.col("stop") - F.col("start") + 1).alias("size")).filter(
        F.col("size") > HELD).select("anchor"), "large")
    if large.isEmpty():
        more = _settled(blocks, length)
    else:
        blocks = stage(blocks.join(large.withColumn("large", F.lit(True)), "anchor", "left"), "blocks")
        more = _settled(blocks.filter("large is null"), length).unionByName(_halved(blocks.filter("large").drop("large"), length, HELD))
    return gone.unionByName(more).groupBy("id", "th").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"))


def cut_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_BYTES,
              keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``keep`` columns), ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes."""
    spans = stage(repeated_spans(docs, id_col, text_col, length), "spans").select(F.col("id").alias("_id"), F.col("th").alias("_th"), "spans")
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text_col).alias("th"))
    rows = rows.join(spans, (F.col("id") == F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("row", "text", "spans")

    def run(batches):
        for b in batches:
            size, removed, count, kept = [], [], [], []
            for text, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                parts, at, n = [], 0, 0
                reach = -1
                for s in found or []:
                    if s["start"] > reach:
                        n += 1
                        parts.append(data[at:s["start"]])
                    reach = at = max(reach, s["stop"])
                parts.append(data[at:])
                rest = b"".join(parts)
                size.append(len(data))
                removed.append(len(data) - len(rest))
                count.append(n)
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
