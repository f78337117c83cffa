"""Models against plain forms written with loops: the classifier's forward pass, the resampler's weights, the
language vectors, and expectation-maximisation over documents."""

import math
import random

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from sentforge.llm import langid, quality, resampling, toxicity

# ------------------------------------------------------------- toxicity ----


def plain_score(m, text):
    words = (text or "").split()
    n_out = len(toxicity.WIDTHS) * toxicity.FILTERS
    pooled = [-1e9] * n_out
    langs = [0.0] * len(m.languages)
    vectors = []
    for w in words:
        feats = toxicity.word_features(w)
        vectors.append(sum(m.embed[f].astype(float) for f in feats) / math.sqrt(len(feats)))
        for k in range(len(langs)):
            langs[k] += float(m.lang_words[feats[0], k])
    tap = 0
    for w, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            for i in range(len(words)):
                r = sum(float(vectors[i + j] @ m.taps[:, (tap + j) * toxicity.FILTERS + f]) for j in range(width) if i + j < len(words))
                pooled[w * toxicity.FILTERS + f] = max(pooled[w * toxicity.FILTERS + f], r)
        tap += width
    logit = sum(max(p + float(b), 0.0) * float(o) for p, b, o in zip(pooled, m.bias, m.out, strict=True)) + m.const
    lang = langs.index(max(langs)) if words else 0
    return 1 / (1 + math.exp(-(logit - float(m.thresholds[lang]))))


@pytest.fixture(scope="module")
def toxic_rows():
    r = random.Random(9)
    common = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(120)]
    bad = ["vexmorl", "quzzak", "brindle"]
    texts, labels, langs = [], [], []
    for i in range(300):
        words = [r.choice(common) for _ in range(r.randint(3, 60))]
        if i % 3 == 0:
            words[r.randrange(len(words))] = r.choice(bad)
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
        langs.append(r.choice(["x", "y", None]))
    return texts, labels, langs


def test_toxicity_equals_the_plain_forward_pass(toxic_rows):
    texts, labels, langs = toxic_rows
    m = toxicity.fit(texts, np.array(labels), langs)
    scorer = toxicity.Scorer(m)
    for t in [*texts[:40], "", None, "one", "a\tb\nc", " ".join(texts[:30])]:
        assert scorer(t) == pytest.approx(plain_score(m, t), abs=2e-4)


def test_toxicity_learns_from_long_rows_too(toxic_rows, spark):
    texts, labels, langs = toxic_rows
    filler = " ".join(t for t, y in zip(texts, labels, strict=True) if not y)
    rows = [(i, (filler + " ") * 3 + t if i % 5 == 0 else t, lang) for i, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    assert max(len(t) for _, t, _ in rows) > 60_000
    docs = spark.createDataFrame([*rows, (900, None, "x"), (901, "no label", "x")], "doc_id bigint, text string, lang string")
    known = [(i, y) for i, y in enumerate(labels)] + [(900, 1), (5, None), (None, 1)]
    m = toxicity.train(docs, spark.createDataFrame(known, "doc_id bigint, toxic int"))
    scorer = toxicity.Scorer(m)
    right = sum((scorer(t) >= 0.5) == bool(y) for (_, t, _), y in zip(rows, labels, strict=True))
    assert right / len(rows) > 0.9


def test_toxicity_learns_from_every_labelled_row(spark):
    r = random.Random(4)
    common = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(120)]
    ids = [x.id for x in spark.range(3500).orderBy(F.xxhash64("id", F.lit(17))).collect()]
    rows, marks = [], []
    for k, i in enumerate(ids):  # the 200 toxic rows whose ids hash highest have a word of their own
        toxic = k % 5 < 2 or k >= 3300
        words = [r.choice(common) for _ in range(8)]
        if toxic:
            words[r.randrange(8)] = "vexmorl" if k < 3300 else "quzzak"
        rows.append((i, " ".join(words), "x"))
        marks.append((i, int(toxic)))
    assert sum(y for _, y in marks[:3300]) > 1000
    docs, labels = spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(marks, "doc_id bigint, toxic int")
    m = toxicity.train(docs, labels)
    tries = [" ".join(r.choice(common) for _ in range(8)) for _ in range(20)]
    scorer = toxicity.Scorer(m)
    assert sum(s >= 0.5 for s in scorer.many([f"{t} quzzak" for t in tries])) >= 18
    assert sum(s < 0.5 for s in scorer.many(tries)) >= 18


def test_toxicity_is_trained_by_several_tasks(toxic_rows, spark, monkeypatch):
    texts, labels, langs = toxic_rows
    monkeypatch.setattr(toxicity, "UNIT_ROWS", 75)
    small = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        docs = spark.createDataFrame(list(zip(range(300), texts, langs, strict=True)), "doc_id bigint, text string, lang string")
        found = [toxicity.train(docs, spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")) for _ in range(2)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    scores = [toxicity.Scorer(m).many(texts) for m in found]
    assert scores[0] == scores[1]
    assert sum((s >= 0.5) == bool(y) for s, y in zip(scores[0], labels, strict=True)) > 0.9 * len(labels)


def test_toxicity_passes_over_many_units_as_often(toxic_rows, spark, monkeypatch):
    texts, labels, langs = (x * 2 for x in toxic_rows)
    docs = spark.createDataFrame(list(zip(range(len(texts)), texts, langs, strict=True)), "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")
    passes, unpack = [], toxicity._unpack
    monkeypatch.setattr(toxicity, "_unpack", lambda vector: passes.append(1) or unpack(vector))  # once a pass on the driver
    found = []
    for rows in (1 << 20, 100):
        monkeypatch.setattr(toxicity, "UNIT_ROWS", rows)
        toxicity.train(docs, marks)
        found.append(len(passes))
        passes.clear()
    assert found == [toxicity.EPOCHS[0]] * 2


def test_toxicity_averages_by_rows():
    a, b = [toxicity.new_model(1) for _ in range(3)], [toxicity.new_model(2) for _ in range(3)]
    a[2].const = 3.0
    frame = pd.DataFrame({"at": [7, 7], "first": [5, 2], "n": [3, 1], "v": [(n * toxicity._pack(x).astype(float)).tobytes() for n, x in ((3, a), (1, b))]})
    out = toxicity._sum(frame)
    models, rest = toxicity._unpack(np.frombuffer(out["v"][0], np.float32))
    assert out["at"].tolist() == [7] and len(rest) == 0 and models[2].const == 2.25
    assert np.allclose(models[1].embed, 0.75 * a[1].embed + 0.25 * b[1].embed, atol=1e-6)


def test_word_features_of_odd_words():
    same = toxicity.word_features("Haus")
    assert same == toxicity.word_features("(haus),") and len(same) == 4
    one, none = toxicity.word_features("é"), toxicity.word_features("...")
    assert len(one) == 1 and len(none) == 3
    words = ["haus", "é", "...", "(haus),", "\ud800x", "𝒳y"]
    flat, starts, scale = toxicity._ragged(words)
    assert [x.tolist() for x in np.split(flat, starts[1:])] == [toxicity.word_features(w) for w in words]
    assert len(scale) == len(words)


def test_long_texts_are_pooled_in_blocks(toxic_rows, monkeypatch):
    texts, labels, langs = toxic_rows
    m = toxicity.fit(texts, np.array(labels), langs)
    many = [*texts[:5], "", " ".join(texts[:9]), None, texts[3]]
    whole = toxicity.Scorer(m).many(many)
    monkeypatch.setattr(toxicity, "_BLOCK", 7)
    assert toxicity.Scorer(m).many(many) == pytest.approx(whole, abs=1e-5)


def test_batches_hold_every_text_once():
    docs = [np.zeros(n) for n in (5, 300_000, 7, 0, 199_999, 3)]
    batches = list(toxicity._batches(np.arange(6), docs))
    assert sorted(np.concatenate(batches)) == list(range(6)) and [1] in [b.tolist() for b in batches]
    assert all(len(b) == 1 or sum(len(docs[i]) for i in b) <= toxicity.BATCH_WORDS for b in batches)


# ------------------------------------------------------------ resampling ----
def signed(x):
    return x - (1 << 64) if x >> 63 else x


def buckets_of(text, n):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    two = [xxhash.xxh64_intdigest(b.encode(), h) for h, b in zip(one, words[1:], strict=False)]
    return [signed(h) % n for h in one + two]


def test_log_weights_equal_counting(make, words, spark):
    rows = [(i, words(5 + i % 40, 700 + i)) for i in range(60)] + [(70, None), (71, ""), (72, "One two\tONE\nTwo one"), (72, "repeated id")]
    docs = make(rows)
    target = [3, 5, 8, 13, 72, 999]
    n = 500
    ratios = resampling.log_ratios(docs, spark.createDataFrame([(x,) for x in [*target, 3]], "doc_id bigint"), buckets=n)
    raw, good = [1.0] * n, [1.0] * n
    for i, t in rows:
        for b in buckets_of(t, n):
            raw[b] += 1
            good[b] += i in target
    want = [math.log(g / sum(good)) - math.log(r / sum(raw)) for g, r in zip(good, raw, strict=True)]
    assert ratios == pytest.approx(want, rel=1e-9)
    got = {(r.row.doc_id, r.row.text): (r.n_grams, r.log_weight) for r in resampling.weigh(docs, ratios).collect()}
    for i, t in rows:
        grams = buckets_of(t, n)
        assert got[i, t][0] == len(grams) and got[i, t][1] == pytest.approx(sum(want[b] for b in grams), abs=1e-9)


# -------------------------------------------------------------- language ----
def plain_bundle(text):
    """Every n-gram bound from its letters' rotated vectors, one by one, and added."""
    codes = [0]
    for c in text or "":
        code = ord(c.lower()[0]) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    codes.append(0)  # the text's end is a break, also after one
    total = [0] * langid.DIMENSIONS
    if not any(codes):
        return total
    vector = {c: langid._vectors(np.array([c]))[0].tolist() for c in set(codes)}
    for i in range(len(codes) - langid.NGRAM + 1):
        for d in range(langid.DIMENSIONS):
            x = 1
            for k in range(langid.NGRAM):
                x *= vector[codes[i + k]][(d - k) % langid.DIMENSIONS]
            total[d] += x
    return total


def test_bundles_equal_loops():
    for text in ("a", "Ab c", "straße 한국어, ok!", "  x--y  ", "12 !?", "", None, "the quick brown fox " * 4):
        assert langid.bundle(text).tolist() == plain_bundle(text)


def test_language_of_a_text_by_plain_cosines(make, spark, words):
    rows = [(i, "the cat and the dog went there " * (1 + i % 3) if i % 2 else "der hund und die katze gingen dort " * (1 + i % 3)) for i in range(20)]
    docs = make([*rows, (30, "ÄÖ"), (31, None)])
    prototypes = langid.train(docs.filter("doc_id < 20"))
    plain = {}
    for i, t in rows:
        v = np.array(plain_bundle(t), float)
        plain.setdefault("en" if i % 2 else "de", []).append(v / np.linalg.norm(v))
    for lang, vs in plain.items():
        mean = sum(vs)
        assert prototypes[lang] == pytest.approx(mean / np.linalg.norm(mean), abs=1e-6)
    for r in langid.identify(docs, prototypes, keep=["doc_id", "text"]).collect():
        v = np.array(plain_bundle(r.text), float)
        if not v.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = {k: float(v @ p) / np.linalg.norm(v) for k, p in prototypes.items()}
        assert r.lang_pred == max(cosines, key=cosines.get) and r.score == pytest.approx(max(max(cosines.values()), 0), abs=1e-9)


def test_thousands_of_languages(spark):
    rows = [(i, f"letters {chr(0x4E00 + i)}{chr(0x5E00 + i)} " * 3, f"l{i}") for i in range(2500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    prototypes = langid.train(docs)
    assert len(prototypes) == 2500


# --------------------------------------------------------------- quality ----
def plain_em(votes):
    """EM over documents, one at a time, with the operator's starting point and its virtual documents."""
    n = len(votes[0])
    prior, rates = quality.START_GOOD, [[r] * n for r in quality.START_BAD_VOTE]

    def good(v):
        odds = math.log(prior / (1 - prior))
        for j, x in enumerate(v):
            g, b = (min(max(rates[c][j], 1e-6), 1 - 1e-6) for c in (0, 1))
            odds += math.log(g / b) if x < 0 else math.log((1 - g) / (1 - b)) if x > 0 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        p = [good(v) for v in votes]
        new = []
        for c in (0, 1):
            side = []
            for j in range(n):
                bad, cast = quality.WEIGHT * quality.START_BAD_VOTE[c], quality.WEIGHT
                for v, g in zip(votes, p, strict=True):
                    if v[j]:
                        cast += g if c == 0 else 1 - g
                        bad += (g if c == 0 else 1 - g) * (v[j] < 0)
                side.append(min(bad / cast, quality.MAX_FALSE) if c == 0 else bad / cast)
            new.append(side)
        prior = min(max((quality.WEIGHT * quality.START_GOOD + sum(p)) / (len(votes) + quality.WEIGHT), 0.01), 0.99)
        rates = new
    return [good(v) for v in votes]


def test_posterior_equals_em_over_documents(make, words):
    r = random.Random(17)
    texts = [words(r.randint(25, 200), 800 + i) for i in range(60)] + [words(30, 900 + i) + " !?" * 40 for i in range(8)]
    texts += [(words(6, 950 + i) + "\n") * 6 for i in range(8)] + [words(30, 980 + i).upper() + " # $ % &" for i in range(8)]
    docs = make([*enumerate(texts), (900, None), (901, "few words"), (0, texts[0])])
    rows = quality.judge(docs).collect()
    names = [f"v_{k}" for k in quality.rules()]
    open_rows = [x for x in rows if not x.base_failed]
    want = plain_em([tuple(x[n] for n in names) for x in open_rows])
    assert len(open_rows) > 60 and [x.quality for x in open_rows] == pytest.approx(want, abs=1e-9)
    assert [x.kept for x in open_rows] == [w >= quality.THRESHOLD for w in want]
    assert not any(x.kept for x in rows if x.base_failed)
