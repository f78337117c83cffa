"""Periodic runs of words, found on a recompression grammar.

A run is a stretch of consecutive words with smallest period ``q`` and at least
``max(MIN_LENGTH, 2 * q)`` words that no neighbour extends.  A run of period
``q`` covers two neighbouring multiples of ``q``, so the pairs ``(k*q, (k+1)*q)``
of the harmonic grid - ``n ln n`` in all - are candidates for every run.  A pair
survives if the three words from, or the three words up to, both places agree
(six places around a multiple are equal in every run).  Survivors are extended
exactly, to both sides, by longest-common-extension queries on a grammar: the
word sequence, and its reverse, is compressed by turns - equal neighbours into
blocks, then neighbours of two alphabet halves into pairs - until one symbol is
left.  Compression is locally consistent, so a query climbs the levels while the
symbols at the uneven edge agree, and steps down from the first pair that
differs.  All queries of a text run as numpy arrays, a level at a time; texts
without surviving candidates need no grammar.

Every text is one row and no row meets another: a lost task is simply run again.

Edge cases: a null or empty text has no words, no run and the hash of the empty
string; repeated rows and ids are treated alike; a null id is no number, so
nothing is repeated into its text; an empty table gives an empty result; other
columns are never read unless they are kept.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIN_LENGTH = 12
GRID = 1 << 14  # places of the harmonic grid that a worker keeps; longer texts compute the rest
QUERIES_AT_ONCE = 1 << 19
_SEEDS = 4  # alphabet halvings tried before pairs are formed


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and every key's number among them."""
    distinct, number = np.unique(keys, return_inverse=True)
    return distinct, number.astype(np.int64)


class Grammar:
    """A run-length grammar of an integer sequence, by recompression.

    ``levels`` holds, from the sequence upwards, ``(symbols, child)``: the symbols
    of a level, and where each begins in the level below.  ``kinds`` tells how a
    level came from the one below: blocks of equal symbols, or pairs."""

    def __init__(self, sequence: np.ndarray):
        s = np.append(_ranks(np.asarray(sequence, dtype=np.int64))[1] + 1, 0)  # the end is a symbol of its own
        self.levels = [(s, np.arange(len(s)))]
        self.kinds = [""]
        while len(s) > 1:
            s = self._blocks(s)
            s = self._pairs(s)

    def _add(self, kind: str, symbols: np.ndarray, child: np.ndarray) -> np.ndarray:
        self.levels.append((symbols, child))
        self.kinds.append(kind)
        return symbols

    def _blocks(self, s: np.ndarray) -> np.ndarray:
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        if len(first) == len(s):
            return s
        count = np.diff(np.append(first, len(s)))
        return self._add("blocks", _ranks(s[first] * (len(s) + 1) + count)[1], first)

    def _pairs(self, s: np.ndarray) -> np.ndarray:
        if len(s) < 2:
            return s
        best, left, seed = 0, None, len(self.levels)
        while best == 0:
            for k in range(_SEEDS):
                mixed = (s.astype(np.uint64) + np.uint64(seed * _SEEDS + k)) * np.uint64(0x9E3779B97F4A7C15)
                half = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)
                for one in (half, ~half):
                    n = int(np.count_nonzero(one[:-1] & ~one[1:]))
                    if n > best:
                        best, left = n, one
            seed += 1
        head = np.append(left[:-1] & ~left[1:], False)  # never overlap: a head is of the left half, its partner is not
        keep = ~np.append(False, head[:-1])
        child = np.flatnonzero(keep)
        partner = np.where(head[child], s[np.minimum(child + 1, len(s) - 1)] + 1, 0)
        return self._add("pairs", _ranks(s[child] * (int(s.max()) + 2) + partner)[1], child)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and from ``j`` (``i != j``) agree."""
        a, b = i.copy(), j.copy()
        top = len(self.levels) - 1
        stop = np.full(len(i), top)  # the level at which the symbols at a and b differ
        live = np.arange(len(i))
        for level in range(1, top + 1):  # climb
            if not len(live):
                break
            s, child = self.levels[level - 1][0], self.levels[level][1]
            x, y = a[live], b[live]
            px = np.searchsorted(child, x, side="right") - 1
            py = np.searchsorted(child, y, side="right") - 1
            inside_x, inside_y = x - child[px], y - child[py]
            uneven = (inside_x > 0) | (inside_y > 0)
            differ = uneven & (s[x] != s[y])
            if self.kinds[level] == "blocks":
                ends = np.append(child[1:], len(s))
                rest_x, rest_y = ends[px] - x, ends[py] - y
                step = np.minimum(rest_x, rest_y)
                short = uneven & ~differ & (rest_x != rest_y)  # one block ends first: the next symbols differ
                a[live[short]] += step[short]
                b[live[short]] += step[short]
                differ = differ | short
            # past the edge: of a block, or of a pair (the equal of a symbol that closes a pair heads none)
            px, py = px + uneven, py + uneven
            stop[live[differ]] = level - 1
            up = ~differ
            a[live[up]], b[live[up]] = px[up], py[up]
            live = live[up]
        for level in range(top, 0, -1):  # step down from symbols that differ
            at = np.flatnonzero(stop >= level)
            if not len(at):
                continue
            s, child = self.levels[level - 1][0], self.levels[level][1]
            x, y = child[a[at]], child[b[at]]
            same = s[x] == s[y]
            if self.kinds[level] == "pairs":
                step = same.astype(np.int64)
            else:
                ends = np.append(child[1:], len(s))
                step = np.where(same, np.minimum(ends[a[at]] - x, ends[b[at]] - y), 0)
            a[at], b[at] = x + step, y + step
        return a - i


def _grid(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(j - d, j)`` for every ``low <= j < high`` and every divisor ``d`` of ``j``, by ``j``."""
    at, gap = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(1, math.isqrt(max(high - 1, 0)) + 1):
        m = np.arange(max(k, -(-low // k)), (high - 1) // k + 1)  # j = k * m with k <= m: both divide it
        more = m[m > k]
        at += [k * m, k * more]
        gap += [np.full(len(m), k), more]
    j, d = np.concatenate(at), np.concatenate(gap)
    order = np.argsort(j, kind="stable")
    return (j - d)[order], j[order]


class _Grid:
    """The harmonic grid up to ``GRID``, and further pieces on demand."""

    def __init__(self):
        self.i = self.j = np.empty(0, np.int64)
        self.have = 0

    def pieces(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        want = min(n, GRID)
        if want > self.have:
            size = min(GRID, max(1024, 1 << (want - 1).bit_length()))
            (self.i, self.j), self.have = _grid(0, size), size
        m = int(np.searchsorted(self.j, want))
        yield self.i[:m], self.j[:m]
        for low in range(GRID, n, GRID):
            yield _grid(low, min(low + GRID, n))


_shared_grid = _Grid()


def periodic_runs(words: list, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows ``(start, length, period)`` of every run, by start, then period."""
    n = len(words)
    none = np.empty((0, 3), np.int64)
    if n < min_length or n < 2:
        return none
    number: dict = {}
    w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, n)
    # three words from a place, as one number (a hash: it may only let a candidate through)
    mix = (w + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mix ^= mix >> np.uint64(31)
    ahead = np.concatenate([mix, np.arange(2, dtype=np.uint64)])
    ahead = ahead[:-2] * np.uint64(3) + ahead[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + ahead[2:] * np.uint64(0x165667B19E3779F9)
    behind = np.concatenate([np.arange(2, dtype=np.uint64) + np.uint64(7), ahead[:-2]])  # three words up to a place
    found: dict[tuple[int, int], int] = {}
    forth = back = None
    for gi, gj in _shared_grid.pieces(n):
        hit = np.flatnonzero((ahead[gi] == ahead[gj]) | (behind[gi] == behind[gj]) if min_length >= MIN_LENGTH else w[gi] == w[gj])
        for k in range(0, len(hit), QUERIES_AT_ONCE):
            i, j = gi[hit[k:k + QUERIES_AT_ONCE]], gj[hit[k:k + QUERIES_AT_ONCE]]
            if forth is None:
                forth, back = Grammar(w), Grammar(w[::-1])
            q = j - i
            right, left = forth.common(i, j), back.common(n - i, n - j)
            start, length = i - left, left + right + q
            ok = length >= np.maximum(min_length, 2 * q)
            if ok.any():
                rows = np.unique(np.stack([start[ok], length[ok], q[ok]], 1), axis=0)
                for s, size, p in rows[np.unique(rows[:, 0] * (n + 1) + rows[:, 1], return_index=True)[1]]:
                    key = (int(s), int(size))
                    found[key] = min(found.get(key, n), int(p))
    if not found:
        return none
    return np.array(sorted(((s, size, p) for (s, size), p in found.items()), key=lambda r: (r[0], r[2])), np.int64)


def planted(words: list, doc_id: int | None) -> list:
    """The words with a stretch of a tenth of the documents made periodic (see the contract of the query)."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def collapse(words: list, runs: np.ndarray) -> list:
    """The words without those that repeat an earlier period of a run."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep, strict=True) if k]


_RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, plant: bool = False,
              keep: list[str] | None = None, texts: bool = True) -> DataFrame:
    """``row`` (struct of the ``keep`` columns), ``n_words``, ``runs`` (start, length, period), ``runs_sha256``,
    ``collapsed_sha256`` and, if ``texts``, ``collapsed`` (the words left, joined by one blank).

    With ``plant``, the words are first changed by ``planted`` (for queries that state their own damage)."""
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(id_col).cast("bigint").alias("id") if plant else
                       F.lit(None).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    fields = [rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("runs", _RUNS),
              T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType())]
    schema = T.StructType(fields + ([T.StructField("collapsed", T.StringType())] if texts else []))
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, runs, told, kept, left = [], [], [], [], []
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = planted((text or "").encode().split(), doc_id)  # bytes.split() cuts at \x20 and \x09-\x0D
                r = periodic_runs(words, min_length)
                out = b" ".join(collapse(words, r))
                n_words.append(len(words))
                runs.append([{"start": int(s), "length": int(k), "period": int(p)} for s, k, p in r])
                told.append(hashlib.sha256("".join(f"{s},{k},{p}\n" for s, k, p in r.tolist()).encode()).hexdigest())
                kept.append(hashlib.sha256(out).hexdigest())
                left.append(out.decode() if texts else None)
            columns = [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(runs, kind), pa.array(told, pa.string()),
                       pa.array(kept, pa.string())] + ([pa.array(left, pa.string())] if texts else [])
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(work, schema)


def longest_run(runs):
    """The run of greatest length (ties: smallest start, then period) of a ``runs`` column, or null."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(F.size(runs) > 0, F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))
