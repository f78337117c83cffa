"""Bulk-synchronous best-fit packing of token sequences.

Documents become token pieces of at most ``capacity``; full pieces have a
sequence each.  The rest are packed by best-fit decreasing, run in bulk: equal
lengths are interchangeable, so the documents are range-sorted into length
classes and the open gaps into gap classes.  A round takes the longest class
still waiting, sweeps the gap classes for its successor (the smallest gap that
holds it), lets ranks inside both classes decide which piece goes to which
sequence, updates the gaps and repeats.  The sweeps work on class counts (at
most ``capacity`` lengths), and every piece then finds its sequence through
its own rank, by a range join on (length, first rank); no task and no driver
step ever holds the documents.

Edge cases: a null or empty text is the separator alone (one token); repeated
rows and ids are packed as often as they occur, null ids too.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentforge.llm.common import stage

CAPACITY = 2048
SEPARATOR = 0
WORD_CACHE = 300_000  # words in a generation of a Python worker's cache
LONG_WORD = 64  # longer ones are not kept
SLICE_ROWS = 50_000  # rows of one length ranked by one task, on average

_encoders: dict[str, WordEncoder] = {}


def _quick(tokenizer):
    """The same vocabulary as a ``tiktoken`` encoding, or None where that could differ.

    Byte-level BPE with one token per merge, numbered in the order of the merges,
    gives equal ids in both libraries; ``tiktoken`` takes a fifth of the time for a word."""
    import tiktoken

    d = json.loads(tokenizer.to_str())
    pre, model = d["pre_tokenizer"] or {}, d["model"]
    plain = not any((d["normalizer"], model.get("dropout"), model.get("ignore_merges"), model.get("continuing_subword_prefix"),
                     model.get("end_of_word_suffix")))
    if not plain or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or model["type"] != "BPE":
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in d["added_tokens"]}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    order = [model["vocab"].get(m, -1) for m in merged]
    if order != sorted(set(order)) or -1 in order:
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed: the byte-level pre-tokenizer's
    return tiktoken.Encoding("quick", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, sorted(special)


class _Words(dict):
    """Ids of blank-led words as bytes, in two generations so that common words stay."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.old = tokenizer, {}
        self.quick, special = _quick(tokenizer) or (None, [])
        # what the quick form leaves alone: special tokens, and characters on whose class Unicode versions differ
        self.rare = re.compile("|".join(["[\u0250-\U0010ffff]", *map(re.escape, special)]))

    def ids(self, word: str) -> list[int]:
        if self.quick and not self.rare.search(word):
            return self.quick(word)
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = array("I", self.ids(" " + word)).tobytes()
        if len(word) <= LONG_WORD:
            if len(self) >= WORD_CACHE:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts by a ``tokenizers`` file, with a cache of words.

    A byte-level BPE token holds a blank at its start or inside white space only,
    so a token always begins at a blank that follows a non-white character: the
    text may be cut there and its words encoded alone.
    """

    cut = re.compile(r"(?<=\S) ")
    odd = re.compile(r"\s ")  # a blank after white space: not every blank is a place to cut

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        first, *rest = self.cut.split(text) if self.odd.search(text) else text.split(" ")
        start = array("I", self.tokenizer.encode(first, add_special_tokens=False).ids).tobytes()
        return start + b"".join(map(self.words.__getitem__, rest))


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, with_ids: bool = False,
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``, one row per token piece.

    Only documents longer than ``capacity`` are cut, into ``capacity``-token
    pieces of which the first may be shorter.  ``ids`` are little-endian
    unsigned 32-bit binary."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    end = np.array([SEPARATOR], "<u4").tobytes()

    def cut(batches):
        enc = _encoder(tokenizer_path)
        for b in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, text in enumerate(b.column(1).to_pylist()):
                buf = (enc.encode(text) if text else b"") + end
                n = len(buf) // 4
                first = n % capacity or min(n, capacity)
                edges = [0, *range(first, n + 1, capacity)]
                for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                    part = buf[4 * lo:4 * hi]
                    row.append(r)
                    piece.append(k)
                    start.append(lo)
                    length.append(hi - lo)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols, names = [*cols, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return rows.mapInArrow(cut, schema)


def best_fit_classes(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing on length classes.

    Returns runs ``(length, first_rank, count, first_sequence, offset)``: the
    pieces of that length with ranks ``first_rank ..`` go to as many consecutive
    sequences, at that offset.  The sequences of a gap class are kept as ranges.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> ranges (first sequence, count)
    sizes: list[int] = []  # open gap sizes, ascending
    sequences = 0

    def put(gap: int, first: int, count: int) -> None:
        if gap > 0 and count > 0:
            if not gaps[gap]:
                bisect.insort(sizes, gap)
            gaps[gap].append((first, count))

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)  # the successor sweep
            if at == len(sizes):
                opened = -(-left // (capacity // length))
                put(capacity, sequences, opened)
                sequences += opened
                continue
            gap = sizes[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del sizes[at]
            # a sequence stays the successor until it holds no more of this length
            per = gap // length
            filled = min(count, left // per)
            rest = left - filled * per if filled < count else 0
            for bins, start, each in ((filled, first, per), (int(rest > 0), first + filled, rest)):
                if bins:
                    for k in range(each):
                        runs.append((length, rank, bins, start, capacity - gap + k * length))
                        rank, left = rank + bins, left - bins
                    put(gap - each * length, start, bins)
            used = filled + int(rest > 0)
            put(gap, first + used, count - used)
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``) plus ``sequence_id`` and ``offset``.

    Ranks inside a length class come from two levels: the rows of a class are
    dealt into hash slices, so that no class is one group, and a slice's rows
    follow those of the slices before it."""
    pieces = stage(pieces, "pieces")
    keys = pieces.columns
    # at most ``capacity`` rows: one count per length
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slices = 1 + max(counts.values(), default=0) // SLICE_ROWS
    runs = np.array(best_fit_classes(counts, capacity), np.int64).reshape(-1, 5)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    rank_bits = 44
    run_keys = (runs[:, 0] << rank_bits) + runs[:, 1]

    dealt = pieces.withColumn("_slice", F.pmod(F.xxhash64(*keys), F.lit(slices)))
    before = dealt.groupBy("length", "_slice").count().select("length", "_slice", F.coalesce(F.sum("count").over(
        Window.partitionBy("length").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = dealt.withColumn("_in", F.row_number().over(Window.partitionBy("length", "_slice").orderBy(*keys)) - 1)
    ranked = ranked.join(before, ["length", "_slice"]).withColumn("_rank", F.col("_before") + F.col("_in")).select(*keys, "_rank")

    def place(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            length = t["length"].to_numpy()
            rank = t["_rank"].to_numpy()
            run = runs[np.searchsorted(run_keys, (length << rank_bits) + rank, side="right") - 1]
            t = t.drop_columns("_rank").append_column("sequence_id", pa.array(run[:, 3] + rank - run[:, 1], pa.int64()))
            yield from t.append_column("offset", pa.array(run[:, 4], pa.int64())).to_batches()

    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)
