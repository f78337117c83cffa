"""Packing, archives, substrings and classifiers against brute force, round trips and held-out rows."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sentforge.llm import langid, packing, substrings, toxicity, warc
from sentforge.llm.common import connected_components

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_words_encode_like_whole_texts():
    enc, whole = packing.WordEncoder(PATH), Tokenizer.from_file(PATH)
    r = random.Random(1)
    bits = [" "] * 8 + list("ab1.'\n\t\r\x0b\x1c\x85 　éß漢🙂ſΩ") + ["<|endoftext|>", "'ll", "  ", "\n\n", " \n", "\n ", "straße"]
    for _ in range(3000):
        t = "".join(r.choice(bits) for _ in range(r.randint(0, 25)))
        assert enc.encode(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_pieces_and_packing(make, odd_rows):
    docs = make(odd_rows + [(50 + k, "word " * (37 * k % 900)) for k in range(60)])
    capacity = 256
    pieces = packing.token_pieces(docs, PATH, capacity=capacity, with_ids=True)
    out = packing.pack(pieces, capacity).collect()
    whole = Tokenizer.from_file(PATH)
    want = []
    for r in docs.collect():
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
        want += [(str(r.doc_id), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((str(r.id), r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in out)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) <= 1.02 * sum(w[3] for w in want) / capacity + 1
    assert packing.pack(packing.token_pieces(docs.limit(0), PATH)).count() == 0


def test_best_fit_equals_one_by_one():
    r = random.Random(4)
    for _ in range(20):
        counts = {r.randint(1, 50): r.randint(1, 40) for _ in range(15)}
        gaps = []
        for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fit = [g for g in gaps if g >= n]
            if fit:
                gaps.remove(min(fit))
                gaps.append(min(fit) - n)
            else:
                gaps.append(50 - n)
        runs = packing.best_fit_classes(counts, 50)
        used = {}
        for length, _, n, first, offset in runs:
            for s in range(first, first + n):
                assert used.get(s, 0) == offset
                used[s] = offset + length
        assert sorted(50 - u for u in used.values()) == sorted(gaps)
        assert {n: sum(x[2] for x in runs if x[0] == n) for n in counts} == counts


PAGES = "page_id bigint, url string, html string, id string, payload string, bundle string"


def test_archive_round_trip(spark):
    rows = [(k, f"http://h/{k}", f"<p>{k % 7}</p>é" * (k % 5 + 1)) for k in range(60)]
    rows += [(100, None, None), (101, "u\r\nx", ""), (102, "u", "long " * 300000), (103, "u", "same"), (103, "u", "same"), (104, "u", "same"), (None, "u", "same"), (None, "u", "alone")]
    pages = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], PAGES).repartition(4)
    index = warc.archive(spark, pages)
    got = warc.read(index).collect()
    largest = {}
    for i, _, h in rows:
        largest[h or ""] = max((x for x in (largest.get(h or ""), i) if x is not None), default=None)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        top = largest[h or ""]
        kind = "response" if i == top else "revisit"
        want.append((str(i), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), kind,
                     str(top) if kind == "revisit" else "None", body if kind == "response" else b""))
    assert sorted((str(r.id), r.payload_bytes, r.payload_digest, r.type, str(r.refers_to), bytes(r.payload)) for r in got) == sorted(want)
    some = index.filter(F.col("id").isin("5", "102", "100"))
    assert sorted((r.id, len(r.payload)) for r in warc.fetch(some).collect() if r.type == "response") == sorted(
        (i, len(b)) for i, _, _, k, _, b in want if i in ("5", "102", "100") and k == "response")
    assert warc.read(warc.archive(spark, pages.limit(0))).count() == 0
    bundles = index.select("bundle").distinct().collect()
    assert len({r.id for r in index.collect()}) == len({str(i) for i, _, _ in rows}) and bundles


def cover(docs, length):
    """``{(id, text): (n_removed, n_spans, kept)}`` by looking at every window."""
    first = {}
    order = [(-(1 << 63) if i is None else i, (t or "").encode(), i, t) for i, t in docs]
    for key, b, _, _ in order:
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            first[w] = min(first.get(w, (key, s)), (key, s))
    out = []
    for key, b, i, _ in order:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (key, s):
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((str(i), len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out)


@pytest.mark.parametrize("batch", [1 << 18, 600])
def test_repeated_substrings(make, words, spark, monkeypatch, batch):
    monkeypatch.setattr(substrings, "_windows", lambda n, limit=batch, f=substrings._windows: f(n, batch))
    a, b = words(60, 1), words(40, 2)
    rows = [(1, a), (2, a), (2, a), (3, b + " " + a), (4, a[:150] + "#" + a[151:]), (5, None), (6, ""), (7, "ab" * 200), (None, b), (None, b[20:]),
            (8, "x" * 99), (9, "x" * 99 + "yx"), (10, a + a), (11, "é" * 90 + b), (2, b + "tail"), (12, words(2000, 3)), (13, words(2000, 3)[500:9000])]
    rows += [(20 + k, words(8, 40 + k) + a[30:220] + words(9, 80 + k)) for k in range(12)]
    docs = make(rows)
    got = substrings.cut_spans(docs, keep=["doc_id"]).collect()
    assert sorted((str(r.row.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == cover(rows, 100)
    assert substrings.cut_spans(docs.limit(0)).count() == 0


def test_many_blocks_of_one_anchor(make, words, monkeypatch):
    a = words(40, 1)
    rows = [(k, words(4, 100 + k) + a + words(5, 900 + k)) for k in range(60)]
    rows += [(k, words(4, 100 + k) + a) for k in (3, 3, 70)] + [(None, a[1:]), (None, "x" + a), (80, a + a)]
    held, whole = 3000, substrings._windows

    def windows(length, limit=600):
        run = whole(length, limit)

        def checked(batches):
            sizes = {}
            for b in batches:
                for anchor, data in zip(b.column("anchor").to_pylist(), b.column("data").to_pylist(), strict=True):
                    sizes[anchor] = sizes.get(anchor, 0) + len(data) + 1
                assert max(sizes.values(), default=0) <= held
                yield from run([b])  # one batch here: the test is small

        return checked

    monkeypatch.setattr(substrings, "HELD", held, raising=False)
    monkeypatch.setattr(substrings, "_windows", windows)
    got = substrings.cut_spans(make(rows), keep=["doc_id"]).collect()
    assert sorted((str(r.row.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == cover(rows, 100)


def test_no_transform_above_the_limit(words, monkeypatch):
    seen, whole = [], substrings.common_prefix_cuts
    monkeypatch.setattr(substrings, "common_prefix_cuts", lambda text, n: seen.append(len(text)) or whole(text, n))
    passage, n = words(60, 1).encode()[:140], 50
    rows = [(7, k, k, 10, 40, b"%010d" % (k * 7919) + passage) for k in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["anchor", "id", "th", "start", "left", "data"])
    gone = set()
    for b in substrings._windows(100, 2000)([batch]):
        for i, _, start, stop in zip(*(c.to_pylist() for c in b.columns), strict=True):
            gone |= {(i, s) for s in range(start, stop - 99)}
    assert gone >= {(k, 10 + o) for k in range(1, n) for o in range(10, 41)} and not any(i == 0 for i, _ in gone)
    assert max(seen, default=0) <= 2000


def test_interval_expansion_finds_common_prefixes():
    r = random.Random(2)
    text = np.array([r.randint(1, 3) for _ in range(300)] + [0])
    order, cut = substrings.common_prefix_cuts(text, 6)
    s = text.tolist()
    for p in range(1, len(s)):
        x, y = s[order[p - 1]:order[p - 1] + 6], s[order[p]:order[p] + 6]
        assert x <= y
        if 0 not in x + y and len(x) == len(y) == 6:
            assert cut[p] == (x != y)


def test_components(spark):
    r = random.Random(6)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 360)]
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    root = {n: n for n in range(400)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {n: find(n) for a, b in links for n in (a, b) if a != b}


def test_languages(make, spark):
    r = random.Random(7)
    stems = {"en": ["the", "ing", "wh", "tion"], "de": ["sch", "ung", "ei", "ü"], "fr": ["eau", "que", "é", "oi"]}
    make_text = lambda lang, n: " ".join("".join(r.choice(stems[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))
    rows = [(k, make_text(lang, 30), lang) for k, lang in enumerate(["en", "de", "fr"] * 40)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "12 34 !!", "fr"), (903, make_text("de", 20000), None), (None, make_text("fr", 20), None), (904, "𐐀𐐁", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit(1))
    out = langid.identify(docs, langid.train(docs.filter("doc_id % 2 = 0")), keep=["doc_id", "lang"]).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert all(got[k] == ("und", 0.0) for k in (900, 901, 902))
    assert got[903][0] == "de" and got[None][0] == "fr" and got[904][0] != "und"
    held = [(r.lang, r.lang_pred) for r in out if r.doc_id is not None and r.doc_id < 900 and r.doc_id % 2]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.identify(docs.limit(0), {}).count() == 0


def test_every_letter_has_its_own_vector():
    def cosine(a, b):
        a, b = langid.bundle(a), langid.bundle(b)
        return a @ b / np.sqrt((a @ a) * (b @ b))

    pairs = ["ét", "中二", "한국"]
    letters = [c for c in map(chr, range(0xAC00, 0xAC00 + 120))] + list("abcdefghijklmnopqrstuvwxyzéèñüßдж中文二") + ["\U00010428"]
    vectors = {langid.bundle(c * 3).tobytes() for c in letters}
    assert len(vectors) == len(letters)
    assert all(abs(cosine(x * 5, y * 5)) < 0.5 for x, y in pairs)
    assert cosine("ÉTÉ", "été") > 0.999
    whole, block = "straße 한국어 " * 50, langid._BLOCK
    try:
        langid._BLOCK = 7
        parts = langid.bundle(whole)
    finally:
        langid._BLOCK = block
    assert np.array_equal(parts, langid.bundle(whole))


def test_toxicity(spark, words):
    r = random.Random(9)
    rows, labels = [], []
    for k in range(240):
        w = words(50, 1000 + k).split()
        if k % 3 == 0:
            w.insert(r.randrange(len(w)), "rotten" + r.choice(["", "ly", "ish"]))
            w.insert(r.randrange(len(w)), "Vile,")
        rows.append((k, " ".join(w), "en" if k % 2 else "de"))
        labels.append((k, int(k % 3 == 0)))
    rows += [(900, None, None), (901, "", "en"), (None, "a rotten thing, vile", None), (902, words(30000, 5) + " rottenly vile, " + words(10, 6), "xx")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("row", F.lit("clash"))
    marks = spark.createDataFrame(labels + [(3, 0), (None, 1), (5000, 1)], "doc_id bigint, toxic int")
    model = toxicity.train(docs.filter("doc_id % 5 != 0"), marks)
    out = {r.doc_id: r.score for r in toxicity.score(docs, model, keep=["doc_id"]).collect()}
    assert len(out) == len(rows) and all(0 <= s <= 1 for s in out.values())
    held = [(out[k], y) for k, y in labels if k % 5 == 0]
    assert sum((s >= 0.5) == bool(y) for s, y in held) >= 0.9 * len(held)
    assert out[900] == out[901] < 0.5
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, marks.filter("toxic = 0")), keep=["doc_id"]).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
