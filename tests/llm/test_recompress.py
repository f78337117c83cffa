"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np

from sentforge.llm import recompress
from sentforge.llm.queries import op13_periodic_runs

SF = "/root/testdata/sf0.001"


def brute(words, least=12):
    """Every period by itself: maximal stretches whose words q apart agree, smallest period kept."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - s
            if length >= max(least, 2 * q):
                best.setdefault((s, length), q)
    return sorted(((s, k, q) for (s, k), q in best.items()), key=lambda r: (r[0], r[2]))


def random_words(r):
    kind, n = r.randrange(5), r.randint(0, 150)
    if kind == 0:
        return [r.choice("ab") for _ in range(n)]
    if kind == 1:
        return ["a"] * n
    if kind == 2:
        unit = [r.choice("abcdef") for _ in range(r.randint(1, 20))]
        return [r.choice("abc") for _ in range(r.randint(0, 9))] + unit * r.randint(1, 9) + unit[:r.randint(0, len(unit))] + [r.choice("ab")] * r.randint(0, 20)
    if kind == 3:  # Fibonacci word: many runs
        x, y = ["a"], ["a", "b"]
        while len(y) < n:
            x, y = y, y + x
        return y[:n]
    w = [r.choice("abcd") for _ in range(n)]
    for _ in range(3):
        at, p = r.randrange(n + 1), r.randint(1, 9)
        w[at:at + 4 * p] = w[at:at + p] * 4
    return w


def test_runs_equal_brute_force():
    r = random.Random(13)
    for _ in range(1500):
        w = random_words(r)
        for least in (12, 4):
            assert [tuple(x) for x in recompress.periodic_runs(w, least).tolist()] == brute(w, least), w


def test_common_extension_equals_plain_comparison():
    r = random.Random(3)
    for _ in range(300):
        w = [r.choice("ab") for _ in range(r.randint(2, 80))] if r.random() < 0.7 else ["a"] * r.randint(2, 60)
        g = recompress.Grammar(np.array([ord(x) for x in w]))
        pairs = [(i, j) for i in range(len(w) + 1) for j in range(len(w) + 1) if i != j]
        i, j = np.array(pairs).T
        want = []
        for a, b in pairs:
            k = 0
            while a + k < len(w) and b + k < len(w) and w[a + k] == w[b + k]:
                k += 1
            want.append(k)
        assert g.common(i, j).tolist() == want
        assert [len(s) for s, _ in g.levels][-1] == 1


def test_grid_holds_every_pair():
    for low, high in ((0, 1), (0, 2), (0, 50), (17, 64), (100, 101)):
        i, j = recompress._grid(low, high)
        assert sorted(zip(i.tolist(), j.tolist(), strict=True)) == sorted((x - d, x) for x in range(max(low, 1), high) for d in range(1, x + 1) if x % d == 0)


def test_long_texts_pass_the_kept_grid(monkeypatch):
    r = random.Random(4)
    monkeypatch.setattr(recompress, "GRID", 64)
    monkeypatch.setattr(recompress, "_shared_grid", recompress._Grid())
    monkeypatch.setattr(recompress, "QUERIES_AT_ONCE", 50)
    for _ in range(60):
        w = random_words(r) + random_words(r)
        assert [tuple(x) for x in recompress.periodic_runs(w).tolist()] == brute(w)


def expected(doc_id, text, plant):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
    return (doc_id, len(runs), *(top and (top[0], top[1], top[2], 1000 * top[1] // top[2]) or (None,) * 4),
            hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = sorted(expected(d.doc_id, d.text, True) for d in docs if len(d.text or "") < 12000)
    ids = {d.doc_id for d in docs if len(d.text or "") < 12000}
    assert len(want) > 150 and sum(x[1] > 0 for x in want) > 10
    got = [tuple(r) for r in op13_periodic_runs(spark, SF).collect()]
    assert len(got) == len(docs) and sorted(x for x in got if x[0] in ids) == want


def test_odd_rows(make, odd_rows):
    docs = make([*odd_rows, (20, "a b " * 30000), (21, "\x85 \x1c x " * 9)])
    got = recompress.find_runs(docs)
    assert got.schema["row"].dataType.names == docs.columns
    rows = got.collect()
    texts = {t for _, t in odd_rows if t is None or len(t) < 9000} | {"\x85 \x1c x " * 9}
    seen = 0
    for r in rows:
        if r.row.text in texts:
            want = expected(r.row.doc_id, r.row.text, False)
            assert (r.row.doc_id, len(r.runs)) == want[:2] and (r.runs_sha256, r.collapsed_sha256) == want[-2:]
            assert hashlib.sha256(r.collapsed.encode()).hexdigest() == r.collapsed_sha256
            seen += 1
    long = next(r for r in rows if r.row.doc_id == 20)
    assert seen > 10 and [tuple(x) for x in long.runs] == [(0, 60000, 2)] and long.collapsed == "a b"
    assert recompress.find_runs(docs.limit(0)).count() == 0
