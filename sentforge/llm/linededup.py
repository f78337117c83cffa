"""Line dedup across the corpus by a segment-partition edit join.

A line (its text between line breaks, without outer white space) goes if an
equal line, or one within ``edits`` byte edits, begins earlier: in a smaller
``doc_id``, or further up in the same text.  Lines are judged on the input, not
on what is left of it.  Lines below ``near_bytes`` must be equal.

Two lines within ``edits`` edits of each other: cut the shorter one into
``edits + 1`` segments, and the other contains one of them unchanged, near its
place.  So each line indexes its segments by (length, number, content) and
probes the substrings that the length difference and the segment's number allow
(``edits = 2``: 3 keys and 12 probes a line).  Keys that no other line has are
dropped before any pair is formed; pairs that share a key must then agree in their byte
pairs but for those that the edits may change.  Candidates are cut to what
differs and verified by the banded bit-parallel algorithm: the ``2 * edits + 1``
cells of a column are bits of one word, and a fold over the longer line updates
them.

Lines without a word always stay.  Edge cases: null texts stay null; a text may
become empty, its row stays; a null id is the smallest; rows of equal id are
ordered by the hash of their text, and fully repeated rows count as one; empty
tables give empty results; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import WHITE, Bitmap, let, stage

EDITS = 2
NEAR_BYTES = 24


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, th, pos, line, h1, h2)`` for every line with a word; 128 bits of hash name a line."""
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("th"),
                    F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("pos", "line"))
    d = d.withColumn("line", F.btrim("line", F.lit(WHITE))).filter("line != ''")
    return d.withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), F.col("line"))})


def _places(edits: int, probe: bool) -> Column:
    """What a line is indexed by, or probes for: structs (less, number, shift) - a segment of a line ``less`` bytes
    shorter, and how far from its place it may stand."""
    out = []
    for less in range(edits + 1 if probe else 1):
        for i in range(edits + 1):
            low, high = (max(-i, less - (edits - i)), min(i, less + edits - i)) if probe else (0, 0)
            out += [F.struct(*[F.lit(v).alias(k) for k, v in (("less", less), ("number", i), ("shift", s))]) for s in range(low, high + 1)]
    return F.array(*out)


def _keys(lines: DataFrame, edits: int, probe: bool) -> DataFrame:
    """``(key, h1)``: a row per place, then one small expression a row, which the JVM compiles."""
    each = lines.select("h1", "bytes", F.inline(_places(edits, probe)))
    length = F.length("bytes") - F.col("less")
    base = F.call_function("div", length, F.lit(edits + 1)).cast("int")
    longer = length - base * (edits + 1)  # so many segments, the last ones, are one byte longer
    start = base * F.col("number") + F.greatest(F.lit(0), longer - (edits + 1 - F.col("number"))) + F.col("shift")
    size = base + F.when(longer >= edits + 1 - F.col("number"), 1).otherwise(0)
    return each.select(F.xxhash64(length, "number", F.substring("bytes", start + 1, size)).alias("key"), "h1")


def segment_keys(lines: DataFrame, edits: int) -> DataFrame:
    """``(key, h1)``: the segments under which a line is found."""
    return _keys(lines, edits, probe=False)


def probe_keys(lines: DataFrame, edits: int) -> DataFrame:
    """``(key, h1)``: the substrings that may equal a segment of a line up to ``edits`` shorter."""
    return _keys(lines, edits, probe=True)


def _sketch(text: Column) -> Column:
    """The parities of a line's byte pairs in 64 hashed classes; one edit changes at most four pairs."""
    def fold(chars: Column) -> Column:
        pairs = F.zip_with(F.slice(chars, 1, F.size(chars) - 1), F.slice(chars, 2, F.size(chars) - 1), lambda a, b: F.xxhash64(a, b))
        bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(h, F.lit(64)).cast("int"))
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda acc, h: acc.bitwiseXOR(bit(h)))

    return let(F.split(text, ""), fold)


PAIRS_AN_EDIT = 4


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of two strings whose lengths differ by at most ``edits``,
    right up to ``edits`` (and more than that beyond); both at least ``edits`` long."""
    width = 2 * edits + 1
    full, bottom = (1 << width) - 1, 1 << (width - 1)

    def fold(p: Column, t: Column) -> Column:
        m = F.size(p)

        def matches(c: Column, j: Column) -> Column:
            out = F.lit(0)
            for k in range(width):
                out = out.bitwiseOR(F.when(F.get(p, j + (k - edits)) == c, 1 << k).otherwise(0))
            return out

        def step(s: Column, eq: Column) -> Column:
            vp, vn = s["vp"], s["vn"]
            d0 = ((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(F.lit(full))

            def after(d: Column) -> Column:
                hp = vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(vp)).bitwiseAND(F.lit(full)))
                hn = d.bitwiseAND(vp)
                below = F.shiftright(d, 1)
                diagonal = s["j"] + edits < m  # column j + 1 still has its lowest row inside the pattern
                at = m - s["j"] - 1 + edits
                dist = s["d"] + F.when(diagonal, F.when(d.bitwiseAND(F.lit(bottom)) != 0, 0).otherwise(1)).otherwise(_bit_at(hp, at) - _bit_at(hn, at))
                return F.struct(
                    hn.bitwiseOR(F.bitwise_not(below.bitwiseOR(hp)).bitwiseAND(F.lit(full))).alias("vp"),
                    below.bitwiseAND(hp).alias("vn"), dist.cast("int").alias("d"), (s["j"] + 1).alias("j"))

            return let(d0, after)

        start = F.struct(F.lit(full ^ ((1 << edits) - 1)).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("d"), F.lit(0).alias("j"))
        return F.aggregate(F.transform(t, matches), start, step, lambda s: s["d"])

    return let(F.split(a, ""), lambda p: let(F.split(b, ""), lambda t: fold(p, t)))


def _shared(x: Column, y: Column, most: Column, tail: bool) -> Column:
    """Length of the common prefix (or suffix) of two strings, at most ``most``: a
    binary search over powers of two that compares substrings."""
    def grow(have: Column, step: Column) -> Column:
        part = lambda s: F.substring(s, F.length(s) - have - step + 1 if tail else have + 1, step)
        return F.when((have + step <= most) & (part(x) == part(y)), have + step).otherwise(have)

    top = F.floor(F.log2(F.greatest(most, F.lit(1)))).cast("int")
    powers = F.transform(F.sequence(top, F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2.0), k).cast("int"))
    return F.aggregate(powers, F.lit(0), grow)


def trimmed(pairs: DataFrame, x: str, y: str, edits: int) -> DataFrame:
    """Cut what both strings share at their ends, but for ``edits`` bytes on either
    side: an edit script never needs the rest."""
    least = F.least(F.length(x), F.length(y))
    d = pairs.withColumn("_head", _shared(F.col(x), F.col(y), least, False))
    d = d.withColumn("_tail", _shared(F.col(x), F.col(y), least - F.col("_head"), True))
    head, tail = F.greatest(F.col("_head") - edits, F.lit(0)), F.greatest(F.col("_tail") - edits, F.lit(0))
    cut = lambda c: F.substring(F.col(c), head + 1, F.length(c) - head - tail)
    return d.withColumns({x: cut(x), y: cut(y)}).drop("_head", "_tail")


def _bit_at(x: Column, at: Column) -> Column:
    return F.when(at < 0, 0).otherwise(F.getbit(x, at).cast("int"))


def _met(x: DataFrame, y: DataFrame) -> DataFrame:
    """The rows ``(key, h1)`` of ``x`` whose key some other line has in ``y``.  A row per key, by a partial aggregate,
    tells that, so a very common key is one row on the side that is hashed."""
    keys = y.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    return x.join(keys.hint("shuffle_hash"), "key").filter((F.col("low") != F.col("h1")) | (F.col("high") != F.col("h1"))).select("key", "h1")


def near_links(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Pairs ``(a, b)`` of different lines within ``edits`` byte edits, as structs ``(h1, h2)``.

    ``lines``: ``h1``, ``h2`` and ``bytes``, one row per line.  First only existence is asked: probes that meet a
    segment of another line, and segments that meet such a probe (``_met``, rows of 16 bytes).  What is left gets
    its sketch, and the join of both drops pairs whose byte pairs differ in more classes than the edits allow.
    Candidates carry half of the hash; both lines of an equal half are verified."""
    segments, probes = segment_keys(lines, edits), probe_keys(lines, edits)
    probes = stage(_met(probes, segments), "probes")
    segments = stage(_met(segments.filter(Bitmap(probes.select("key").distinct()).holds(F.col("key"))), probes), "segments")
    some = probes.select("h1").unionByName(segments.select("h1")).distinct()
    texts = lines.filter(Bitmap(some).holds(F.col("h1"))).join(some, "h1", "left_semi").select(
        "h1", "h2", F.decode("bytes", "ISO-8859-1").alias("bytes"))  # from here on one character per byte
    texts = stage(texts.withColumn("sketch", _sketch(F.col("bytes"))), "texts")
    sketches = texts.select("h1", "sketch")
    s, p = segments.join(sketches, "h1").alias("s"), probes.join(sketches, "h1").alias("p")
    close = F.bit_count(F.col("s.sketch").bitwiseXOR(F.col("p.sketch"))) <= PAIRS_AN_EDIT * edits
    found = s.join(p, (F.col("s.key") == F.col("p.key")) & (F.col("s.h1") != F.col("p.h1")) & close)
    pairs = stage(found.select(F.least("s.h1", "p.h1").alias("a"), F.greatest("s.h1", "p.h1").alias("b")).distinct(), "candidates")
    side = lambda n, t: texts.select(F.col("h1").alias(n), F.struct("h1", "h2").alias(f"{n}_line"), F.col("bytes").alias(t))
    both = trimmed(pairs.join(side("a", "x"), "a").join(side("b", "y"), "b"), "x", "y", edits)
    near = F.when(F.abs(F.length("x") - F.length("y")) <= edits, banded_distance(F.col("x"), F.col("y"), edits) <= edits).otherwise(False)
    return both.filter(near).select(F.col("a_line").alias("a"), F.col("b_line").alias("b")).distinct()


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
               near_bytes: int = NEAR_BYTES) -> DataFrame:
    """``(id, th, at, n_lines, n_near)``: for each text the places of the lines that stay,
    its number of lines, and how many first copies went for an earlier near copy."""
    lines = _lines(docs, id_col, text_col)
    firsts = stage(lines.groupBy("h1", "h2").agg(F.min(F.struct("id", "th", "pos")).alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    # a line that occurs once is surely its own first; copies meet by their hash, combined before the shuffle
    copied = Bitmap(firsts.filter("n > 1").select("h1")).holds(F.col("h1"))
    long_line = lines.filter(F.octet_length("line") >= near_bytes)
    single = long_line.filter(~copied).select("h1", "h2", "line")
    several = long_line.filter(copied).groupBy("h1", "h2").agg(F.min("line").alias("line"))
    each = stage(single.unionByName(several).select("h1", "h2", F.encode("line", "UTF-8").alias("bytes")), "lines")  # read several times
    links = stage(near_links(each, edits), "links")
    side = lambda n: firsts.select(F.struct("h1", "h2").alias(n), F.col("first").alias(f"f{n}"))
    late = links.join(side("a"), "a").join(side("b"), "b").select(
        F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("late")).distinct()
    judged = firsts.join(late, F.struct("h1", "h2") == late.late, "left").select("first.*", F.col("late").isNotNull().alias("near"))
    kept = judged.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.when(~F.col("near"), F.col("pos")))).alias("at"),
                                          F.count_if("near").alias("n_near"))
    return stage(kept, "kept")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS,
                near_bytes: int = NEAR_BYTES, counts: bool = False) -> DataFrame:
    """``docs`` with the repeated lines taken out of their texts; with ``counts``
    also ``_n_lines``, ``_n_removed`` and ``_n_near``."""
    kept = kept_lines(docs, id_col, text_col, edits, near_bytes)
    d = docs.withColumn("_th", F.xxhash64(text_col)).join(
        kept.select(F.col("id").alias("_id"), F.col("th").alias("_h"), F.col("at").alias("_at"), F.col("n_near").alias("_n_near")),
        docs[id_col].eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_h")), "left")
    before = lambda at, i: F.when(i > 0, F.get(at, i - 1)).otherwise(-1)
    stays = F.flatten(F.transform("_at", lambda x, i: F.concat(
        F.array_repeat(F.lit(False), x - before(F.col("_at"), i) - 1), F.array(F.lit(True)))))
    lines = F.split(text_col, "\n")
    word = lambda x: F.btrim(x, F.lit(WHITE)) != ""
    marked = F.zip_with(lines, F.coalesce(stays, F.array().cast("array<boolean>")), lambda x, s: F.when(F.coalesce(s, F.lit(False)) | ~word(x), x))
    d = d.withColumn("_marked", marked)
    text = F.array_join(F.array_compact("_marked"), "\n")
    out = [F.when(F.col(text_col).isNotNull(), text).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if counts:
        out += [F.coalesce(F.size(F.filter(lines, word)), F.lit(0)).cast("bigint").alias("_n_lines"),
                F.coalesce(F.size("_marked") - F.size(F.array_compact("_marked")), F.lit(0)).cast("bigint").alias("_n_removed"),
                F.coalesce("_n_near", F.lit(0)).alias("_n_near")]
    return d.select(*out)
