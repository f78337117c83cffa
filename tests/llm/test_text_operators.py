"""Operators on words and lines against brute force."""

import re

import xxhash
from pyspark.sql import functions as F

from sentforge.llm import decontaminate, linededup, quality, resampling, simhash

WHITE = r"[^\x20\x09-\x0D]+"


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def fingerprint(text):
    w = re.findall(WHITE, low(text))
    sh = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_simhash_groups(make, odd_rows):
    got = simhash.near_duplicate_groups(make(odd_rows)).collect()
    fps = {t: fingerprint(t) for _, t in odd_rows}
    comp = components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, t in odd_rows:
        if i is not None:
            least[comp[fps[t]]] = min(least.get(comp[fps[t]], i), i)
    want = sorted((str(i), fps[t], least.get(comp[fps[t]])) for i, t in odd_rows)
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component_id) for r in got) == want


def test_simhash_links_every_close_pair(spark):
    r = __import__("random").Random(3)
    base = [r.getrandbits(64) for _ in range(30)]
    values = {b ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for b in base for _ in range(6)} | set(base)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = {frozenset((x.a % (1 << 64), x.b % (1 << 64))) for x in simhash.hamming_links(spark.createDataFrame([(v,) for v in signed], "fp bigint")).collect()}
    assert got == {frozenset((a, b)) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}


def test_drop_near_duplicates_keeps_one_each(make, odd_rows, spark):
    docs = make(odd_rows)
    out = simhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = out.collect()
    fps = [fingerprint(r.text) for r in kept]
    comp = components(sorted({fingerprint(t) for _, t in odd_rows}), lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(comp[f] for f in fps) == sorted(set(comp.values()))
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_line_dedup(make, words):
    line = words(12, 9)
    near = line[:20] + "#" + line[21:]
    far = line[:5] + "###" + line[8:]
    rows = [(1, f"{line}\n\nshort\n{line}"), (2, f"  {near}\nshort\nunique {words(9, 10)}"), (3, f"{far}\nother words"), (4, None), (5, ""),
            (6, line[1:] + "xy"), (None, "short"), (7, f"{words(9000, 11)}\n{words(9, 12)}"), (7, "\n \n"), (7, "\n \n")]
    docs = make(rows)
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    seen: dict[str, tuple] = {}
    order = sorted(((i is not None, i or 0, t) for i, t in rows), key=lambda x: x[:2])
    for has, i, t in order:
        for k, raw in enumerate((t or "").split("\n")):
            x = raw.strip(" \t\n\x0b\x0c\r")
            if x:
                seen.setdefault(x, (has, i, k))

    def text(has, i, t):
        keep = []
        for k, raw in enumerate(t.split("\n")):
            x = raw.strip(" \t\n\x0b\x0c\r")
            again = x and seen[x] != (has, i, k)
            again = again or (len(x.encode()) >= 24 and any(
                len(y.encode()) >= 24 and abs(len(x) - len(y)) <= 4 and seen[y] < seen[x] and edit(x.encode(), y.encode()) <= 2 for y in seen if y != x))
            if not again:
                keep.append(raw)
        return "\n".join(keep)

    want = sorted((str(i if has else None), None if t is None else text(has, i, t)) for has, i, t in order if t is not None)
    assert sorted((str(r.doc_id), r.text) for r in out.collect() if r.text is not None) == want
    assert out.filter("text is null").count() == 1
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_sketches_never_part_near_lines(spark):
    """Up to two byte edits change at most eight of the sketch's classes."""
    r = __import__("random").Random(21)
    pairs = []
    for _ in range(400):
        a = "".join(r.choice("ab c") for _ in range(r.randint(24, 90)))
        b = list(a)
        for _ in range(r.randint(0, 2)):
            at, kind = r.randrange(len(b)), r.randrange(3)
            b[at:at + (kind != 0)] = [] if kind == 2 else [r.choice("abcd ")]
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    apart = F.bit_count(linededup._sketch(F.col("a")).bitwiseXOR(linededup._sketch(F.col("b"))))
    assert df.select(F.max(apart)).first()[0] <= 2 * linededup.PAIRS_AN_EDIT


def test_a_family_of_near_copies(make, words):
    """Variants of one line: those one edit from the first go, those a word away stay, as every pair by itself says."""
    base = words(40, 31)
    parts = base.split(" ")
    changed = [" ".join([*parts[:k], words(1, 500 + k), *parts[k + 1:]]) for k in range(40)]
    typed = [base[:k] + "#" + base[k + 1:] for k in range(0, 120, 3)]
    rows = [(i, t) for i, t in enumerate([base, *changed, *typed])]
    kept = {r.doc_id: r.text for r in linededup.dedup_lines(make(rows)).collect()}
    for i, t in rows:
        near = any(x != t and abs(len(x.encode()) - len(t.encode())) <= 2 and edit(x.encode(), t.encode()) <= 2 for j, x in rows if j < i)
        again = any(x == t for j, x in rows if j < i)
        assert kept[i] == ("" if near or again else t)


def test_banded_distance_equals_edit_distance(spark):
    r = __import__("random").Random(8)
    pairs = []
    for _ in range(200):
        a = "".join(r.choice("abc") for _ in range(r.randint(4, 30)))
        b = list(a)
        for _ in range(r.randint(0, 4)):
            k = r.randrange(len(b))
            b[k:k + 1] = r.choice([[], [b[k], "a"], ["c"]]) if len(b) > 3 else b[k:k + 1]
        if abs(len(a) - len(b)) <= 2 and len(b) >= 3:
            pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    cut = linededup.trimmed(df.selectExpr("*", "a as x", "b as y"), "x", "y", 2)
    assert {(r.a, r.b) for r in cut.collect()} >= {p for p in pairs if edit(*p) <= 2}
    for row in cut.select("a", "b", linededup.banded_distance(F.col("x"), F.col("y"), 2).alias("d")).collect():
        assert min(row.d, 3) == min(edit(row.a, row.b), 3), row
    for row in df.select("a", "b", linededup.banded_distance(F.col("a"), F.col("b"), 2).alias("d")).collect():
        assert min(row.d, 3) == min(edit(row.a, row.b), 3), row


def test_decontamination(make, spark, words):
    item, short, other = words(25, 20), "alpha BETA gamma", words(12, 21)
    items = spark.createDataFrame([(1, item), (2, short), (3, ""), (4, None), (None, other), (5, item)], "item_id bigint, text string")
    rows = [(1, words(40, 22) + " " + item.upper() + ". " + words(5, 23)), (2, "x alpha, beta; gamma alpha beta gamma"), (3, None), (4, ""),
            (5, words(500, 24)), (None, other), (6, " ".join(item.split()[3:13])), (6, " ".join(item.split()[3:12])), (7, item), (7, item)]
    got = decontaminate.contamination(make(rows), items).collect()
    pat = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = {}
    for i, t in [(1, item), (2, short), (None, other), (5, item)]:
        w = pat.findall(low(t))
        for k in range(max(1, len(w) - 9)):
            wins.setdefault(tuple(w[k:k + 10]), set()).add("" if i is None else str(i))
    want = []
    for i, t in rows:
        w, hit, names = pat.findall(low(t)), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if s := wins.get(tuple(w[k:k + n])):
                    names |= s
                    hit.update(range(k, k + n))
        want.append((str(i), len(w), len(hit), sorted(names)))
    assert sorted((str(r.id), r.n_words, r.n_hit, r["items"]) for r in got) == sorted(want)
    docs = make(rows)
    out = decontaminate.drop_contaminated(docs, items)
    assert out.columns == docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(i for i, _, h, _ in want if not h)
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0


def test_quality_statistics_and_votes(make, odd_rows, words):
    symbols = [(100 + k, " ".join(f"{w}###" for w in words(60, 50 + k).split())) for k in range(6)]
    clean = [(200 + k, words(70, 80 + k) + ".\n" + words(20, 120 + k)) for k in range(30)]
    got = quality.judge(make(odd_rows + symbols + clean), keep=["doc_id"]).collect()
    want = []
    for i, t in odd_rows + symbols + clean:
        w = re.findall(WHITE, t or "")
        lines = [x for x in (t or "").split("\n") if re.search(WHITE, x)]
        at = {}
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k:k + 8]), []).append(k)
        cover = {p for ps in at.values() if len(ps) > 1 for k in ps for p in range(k, k + 8)}
        want.append((str(i), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(cover),
                     len(w) < 20 or 100 * len(cover) > 30 * len(w)))
    assert sorted((str(r.row.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == sorted(want)
    kept = {r.row.doc_id for r in got if r.kept}
    assert not any(r.kept and r.base_failed for r in got)
    assert {i for i, _ in clean} <= kept and not kept & {i for i, _ in symbols}
    docs = make(clean)
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_em_follows_the_votes():
    prior, rates = quality.fit([((1, 1, 1), 900), ((-1, 1, 1), 30), ((1, -1, 1), 40), ((0, 0, 0), 10)], 3)
    assert quality.posterior((1, 1, 1), prior, rates) > 0.7
    assert quality.posterior((-1, 1, 1), prior, rates) < 0.5
    assert quality.fit([], 3)[0] == quality.START_GOOD


def test_resampling(make, spark, odd_rows, words):
    good = [(300 + k, words(40, 1)) for k in range(4)]
    junk = [(400 + k, "zzz " * 40) for k in range(4)]
    docs = make(odd_rows + good + junk)
    out = resampling.resample(docs, spark.createDataFrame([(i,) for i, _ in good], "doc_id bigint"), keep=["doc_id"]).collect()
    assert len(out) == len(odd_rows) + 8
    weight = {r.doc_id: r.log_weight for r in out}
    assert min(weight[i] for i, _ in good) > max(weight[i] for i, _ in junk)
    assert weight[5] == weight[6] == 0
    keys = sorted((r.key for r in out), reverse=True)
    k = int(0.5 * len(out) + 0.5)
    assert {r.key for r in out if r.selected} == {x for x in keys if x >= keys[k - 1]}
    assert resampling.resample(docs.limit(0), spark.createDataFrame([], "doc_id bigint")).count() == 0


def test_kth_largest(spark):
    inf = float("inf")
    values = [float(i % 97) for i in range(6000)] + [1e300, -1e300, -inf, inf, 1.7e308, -1.7e308]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    for k in (1, 2, 3, 50, 3000, 6004, 6005, 6006):
        assert resampling.kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert resampling.kth_largest(df, "x", 0) is None and resampling.kth_largest(df, "x", 7000) is None


def test_kth_largest_ends_on_odd_values(spark):
    import math

    one = spark.createDataFrame([(0.5,)] * 5000, "x double")
    assert resampling.kth_largest(one, "x", 4999) == 0.5
    close = [0.1 + i * math.ulp(0.1) for i in range(5000)]
    df = spark.createDataFrame([(v,) for v in close], "x double")
    assert resampling.kth_largest(df, "x", 1234) == sorted(close, reverse=True)[1233]
    tiny = [i * 5e-324 for i in range(5000)]
    assert resampling.kth_largest(spark.createDataFrame([(v,) for v in tiny], "x double"), "x", 77) == sorted(tiny, reverse=True)[76]
    nan = spark.createDataFrame([(float("nan"),)] * 3 + [(float("inf"),)] + [(float(i),) for i in range(5000)], "x double")
    assert math.isnan(resampling.kth_largest(nan, "x", 3)) and resampling.kth_largest(nan, "x", 4) == math.inf
    assert resampling.kth_largest(nan, "x", 5) == 4999.0
    assert resampling.kth_largest(one.limit(0), "x", 1) is None


