"""Toxicity by a convolutional text classifier.

A word's vector is the scaled sum of hashed embeddings of the word and of its
letter 4-grams; filters of several widths slide over the words, each filter's
largest response over the whole text (max pooling) feeds a logistic output.
Everything is trained here in numpy.  A threshold per language shifts the logit
so that 0.5 separates the classes; the language is guessed from the text's
words, never read from the row.

Every labelled row is learnt from, whole texts of any length.  Each pass over
them (``EPOCHS``) is a Spark job: the rows are dealt by id into units, every unit
starts from the common parameters and steps through its rows in small batches,
and the units' parameters are averaged by their numbers of rows.  Many units pass
over their rows as often as one does.  Beside the
model of all rows two models of either half of them are trained; the thresholds
come from all rows, each scored by the half's model that has not seen it.
Scoring takes whole texts too.  Words that no labelled toxic row has cannot be
known: a few dozen toxic rows are too few (README).

Edge cases: null and empty texts score like a text without any response; an id
labelled twice counts with its larger label; without rows of both classes
every score is 0; repeated rows get equal scores.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import stage

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
DIMENSIONS = 16
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = (4, 12)  # passes over the rows, more than 4 if they are few
BATCH = 32
LEAST_STEPS = 48  # of a model, if so many passes give them
BATCH_WORDS = 200_000  # words of a batch; a longer text is a batch of its own
RATE = 0.08
UNIT_ROWS = 4096  # labelled rows of a unit of the training, about
MAX_TASKS = 128  # tasks that train the units; each returns one sum of its units' parameters
GRAM = 4
_TAPS = sum(WIDTHS)
_OUTS = len(WIDTHS) * FILTERS
_EACH = np.arange(_OUTS)
_BLOCK = 50_000  # words convolved at a time
_LONG = 24  # features of a word added up place by place; the rest of a longer one at once
_READ = 256  # rows split into words at a time
_CHUNKS = 64  # pieces in which the tasks' parameters are averaged
_STEP = 100  # logits are counted in steps of 1 / _STEP
_GRAM_KEYS = np.random.default_rng(7).integers(1 << 62, 1 << 63, GRAM, np.uint64) | np.uint64(1)
_WORD_KEY = np.uint64(0x9E3779B97F4A7C15)


@cache
def _word_chars() -> np.ndarray:
    """Whether a code point is a letter, digit or underscore of any script."""
    found = np.zeros(0x110000, bool)
    found[[m.start() for m in re.finditer(r"\w", "".join(map(chr, range(len(found)))))]] = True
    return found


def split(text: str | None) -> list[str]:
    return (text or "").lower().split()


def word_features(word: str) -> list[int]:
    """Buckets of the lower-cased word without outer punctuation, and of its letter n-grams."""
    return _ragged([word.lower()])[0].tolist()


def _ragged(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the lower-cased words' features, a word's first place in them, and its scale."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    codes = np.frombuffer(" ".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    gaps = np.flatnonzero(codes == ord(" "))
    first, end = np.concatenate([[0], gaps + 1]), np.append(gaps, len(codes))
    inner = np.flatnonzero(_word_chars()[codes])
    low, high = np.searchsorted(inner, first), np.searchsorted(inner, end)
    some = high > low  # a word of punctuation only stays whole
    first[some], end[some] = inner[low[some]], inner[high[some] - 1] + 1
    sizes = end - first
    framed = sizes + 2  # <word>
    begin = np.cumsum(framed) - framed
    place = np.arange(framed.sum()) - np.repeat(begin, framed)
    chars = codes[np.clip(np.repeat(first - 1, framed) + place, 0, len(codes) - 1)].astype(np.uint64)
    chars[begin], chars[begin + framed - 1] = ord("<"), ord(">")
    powers = np.multiply.accumulate(np.full(framed.max(), _WORD_KEY))
    shift = np.uint64(64 - BUCKET_BITS)
    starts = np.cumsum(sizes) - sizes  # a word of n letters has n - 1 n-grams
    flat = np.zeros(sizes.sum(), np.int64)
    rest = np.ones(len(flat), bool)
    rest[starts] = False
    flat[starts] = np.add.reduceat(chars * powers[place], begin) >> shift
    at = np.flatnonzero(place < np.repeat(sizes - 1, framed))
    flat[rest] = sum(chars[at + j] * k for j, k in enumerate(_GRAM_KEYS)) >> shift if len(at) else 0
    return flat, starts, 1 / np.sqrt(sizes).astype(np.float32)


@dataclass
class Model:
    embed: np.ndarray
    taps: np.ndarray  # DIMENSIONS x (_TAPS * FILTERS)
    bias: np.ndarray
    out: np.ndarray
    const: float
    languages: list[str] = field(default_factory=list)
    lang_words: np.ndarray | None = None  # BUCKETS x languages, log rates
    thresholds: np.ndarray | None = None
    seen: dict[str, np.ndarray] | None = None  # sums of squared gradients, while it is trained

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.out + self.const


def new_model(seed: int = 3) -> Model:
    rng = np.random.default_rng(seed)
    m = Model(rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32),
              rng.normal(0, 0.3, (DIMENSIONS, _TAPS * FILTERS)).astype(np.float32), np.zeros(_OUTS, np.float32),
              rng.normal(0, 0.3, _OUTS).astype(np.float32), 0.0)
    m.seen = {k: np.full(v, 1e-4, np.float32) for k, v in (("embed", BUCKETS), ("taps", m.taps.shape), ("bias", _OUTS), ("out", _OUTS))}
    return m


def convolve(taps: np.ndarray) -> np.ndarray:
    """Responses of every filter at every word from the words' tap responses (zeros past the end)."""
    n, t = len(taps), 0
    out = np.empty((n, _OUTS), taps.dtype)
    for w, width in enumerate(WIDTHS):
        c = out[:, w * FILTERS:(w + 1) * FILTERS]
        c[:] = taps[:, t * FILTERS:(t + 1) * FILTERS]
        for j in range(1, min(width, n)):
            c[:-j] += taps[j:, (t + j) * FILTERS:(t + j + 1) * FILTERS]
        t += width
    return out


def _batches(order: np.ndarray, docs: list, most: int = BATCH, most_words: int = BATCH_WORDS) -> Iterator[np.ndarray]:
    """Runs of at most ``most`` texts and ``most_words`` words."""
    batch, size = [], 0
    for d in order:
        if batch and (len(batch) == most or size + len(docs[d]) > most_words):
            yield np.array(batch)
            batch, size = [], 0
        batch.append(d)
        size += len(docs[d])
    if batch:
        yield np.array(batch)


class Words:
    """The distinct words of some texts with their features, and each text's words as places among them."""

    def __init__(self, docs: list[list[str]]):
        index = defaultdict()
        index.default_factory = index.__len__  # a new word gets the next place
        self.docs = [np.fromiter(map(index.__getitem__, d), np.int64, len(d)) for d in docs]
        self.flat, self.starts, self.scale = _ragged(list(index))
        self.sizes = np.diff(np.append(self.starts, len(self.flat)))

    def vectors(self, embed: np.ndarray, used: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Scaled sums of the embeddings of the features of the ``used`` words."""
        starts, sizes = self.starts[used], self.sizes[used]
        order = np.argsort(-sizes, kind="stable")
        at, left = starts[order], np.searchsorted(-sizes[order], -np.arange(_LONG))
        out = embed.take(self.flat[at], axis=0)
        for j in range(1, _LONG):  # the j-th feature of all words that have one
            if not left[j]:
                break
            out[:left[j]] += embed.take(self.flat.take(at[:left[j]] + j), axis=0)
        for k in np.flatnonzero(sizes[order] > _LONG):
            out[k] += embed[self.flat[at[k] + _LONG:at[k] + sizes[order[k]]]].sum(axis=0)
        back = np.empty_like(out)
        back[order] = out
        return back * self.scale[used][:, None]


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows of values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(values[order], first, axis=0)


def _step(m: Model, words: Words, batch: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
    """One Adagrad step on a batch of texts, none empty."""
    docs, pad, first_tap = [words.docs[d] for d in batch], max(WIDTHS) - 1, np.cumsum([0, *WIDTHS])
    place = np.zeros(len(words.starts), np.int64)
    for d in docs:
        place[d] = 1
    used = np.flatnonzero(place)
    place[used] = np.arange(len(used))
    x = np.concatenate([words.vectors(m.embed, used), np.zeros((1, DIMENSIONS), np.float32)])  # the last row pads
    lens = np.array([len(d) for d in docs])
    begin = np.cumsum(lens + pad) - (lens + pad)
    rows = np.full(int((lens + pad).sum()), len(used))
    taps, at, peaks = x @ m.taps, np.empty((len(docs), _OUTS), np.int64), np.empty((len(docs), _OUTS), np.float32)
    for k, (b, d) in enumerate(zip(begin, docs, strict=True)):
        rows[b:b + len(d)] = place[d]
        responses = convolve(taps.take(rows[b:b + len(d)], axis=0))  # a text at a time stays in the processor's cache
        top = responses.argmax(axis=0)
        at[k], peaks[k] = b + top, responses[top, _EACH]
    h = np.maximum(peaks + m.bias, 0)
    e = (1 / (1 + np.exp(-np.clip(h @ m.out + m.const, -30, 30))) - labels) * weights / len(lens)
    back = e[:, None] * m.out * (h > 0)
    grads = {"taps": np.zeros_like(m.taps), "bias": back.sum(axis=0), "out": e @ h}
    keys, values = [], []
    for w, width in enumerate(WIDTHS):
        own = slice(w * FILTERS, (w + 1) * FILTERS)
        for j in range(width):
            cols = slice((first_tap[w] + j) * FILTERS, (first_tap[w] + j + 1) * FILTERS)
            r = rows[at[:, own] + j]
            grads["taps"][:, cols] = np.einsum("nfd,nf->df", x[r], back[:, own])
            keys.append(r.ravel())
            values.append((back[:, own, None] * m.taps[:, cols].T[None]).reshape(-1, DIMENSIONS))
    for name, g in grads.items():
        m.seen[name] += g ** 2
        setattr(m, name, (getattr(m, name) - RATE * g / np.sqrt(m.seen[name])).astype(np.float32))
    m.const -= RATE * float(e.sum())
    hot, gx = _sums(np.concatenate(keys), np.concatenate(values))
    some = (hot < len(used)) & gx.any(axis=1)
    if not some.any():
        return
    hot, gx = used[hot[some]], gx[some]
    sizes = words.sizes[hot]
    flat = words.flat[np.repeat(words.starts[hot] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    touched, ge = _sums(flat, np.repeat(gx * words.scale[hot][:, None], sizes, axis=0))
    m.seen["embed"][touched] += (ge ** 2).mean(axis=1)
    m.embed[touched] -= (RATE * ge / np.sqrt(m.seen["embed"][touched])[:, None]).astype(np.float32)


def _learn(models: list[Model], docs: list[list[str]], order: np.ndarray, labels: np.ndarray, halves: np.ndarray, share: float,
           langs: np.ndarray | None = None, counts: np.ndarray | None = None) -> None:
    """Train the model of all rows and those of either half on texts given by their words; ``counts``: add up the words' buckets by language."""
    weights = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    for batch in _batches(order, docs):
        batch = batch[[len(docs[d]) > 0 for d in batch]]
        words = Words([docs[d] for d in batch])
        for m, own in zip(models, (halves[batch] >= 0, halves[batch] == 0, halves[batch] == 1), strict=True):
            if own.any():
                _step(m, words, np.flatnonzero(own), labels[batch[own]], weights[batch[own]])
        if counts is not None:
            for d, lang in zip(words.docs, langs[batch], strict=True):
                if lang >= 0:
                    counts[:, lang] += np.bincount(words.flat[words.starts[d]], minlength=BUCKETS)


def _pool(m: Model, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Every filter's largest response in each text (-1e9 without words), and the text's log rates by language."""
    pad, n_tap = max(WIDTHS) - 1, _TAPS * FILTERS
    pooled = np.full((len(docs), _OUTS), -1e9, np.float32)
    langs = np.zeros((len(docs), m.lang_words.shape[1]))
    # a piece looks at the first words of the next
    pieces = [(d, words[at:at + _BLOCK + pad]) for d, words in enumerate(docs) for at in range(0, len(words), _BLOCK)]
    for some in _batches(np.arange(len(pieces)), [p for _, p in pieces], len(pieces), _BLOCK + pad):
        words = Words([pieces[k][1] for k in some])
        table = np.concatenate([words.vectors(m.embed) @ m.taps, m.lang_words[words.flat[words.starts]]], axis=1)
        for k, words_of in zip(some, words.docs, strict=True):
            d, n = pieces[k][0], min(len(words_of), _BLOCK)
            rows = table.take(words_of, axis=0)  # a text at a time stays in the processor's cache
            pooled[d] = np.maximum(pooled[d], convolve(rows[:, :n_tap])[:n].max(axis=0))
            langs[d] += rows[:n, n_tap:].sum(axis=0, dtype=np.float64)
    return pooled, langs


def _log_rates(counts: np.ndarray) -> np.ndarray:
    rates = counts + 0.1
    return np.log(rates / rates.sum(axis=0)).astype(np.float32)


def _finish(models: list[Model], counted: list[tuple[int, int, int, int]]) -> Model:
    """The model of all rows with the thresholds from ``(language, logit step, label, rows)``, each row scored by the other half's model."""
    m = models[0]
    lang, step, label, n = (np.array(x) for x in zip(*counted, strict=True)) if counted else [np.zeros(0, int)] * 4
    common = _threshold(step, label, n, 0.0)
    m.thresholds = np.full(len(m.languages), common)
    for k in range(len(m.languages)):
        own = lang == k
        weight = min(1.0, n[own & (label == 1)].sum() / 100)  # few toxic rows say little about their language's threshold
        m.thresholds[k] += weight * (_threshold(step[own], label[own], n[own], common) - common)
    m.seen = None
    return m


def _threshold(steps: np.ndarray, truth: np.ndarray, n: np.ndarray, otherwise: float) -> float:
    """The middle of the widest gap among the cuts with the fewest errors."""
    if len(set(truth.tolist())) < 2:
        return otherwise
    x, where = np.unique(steps, return_inverse=True)
    bad, good = (np.bincount(where, n * (truth == k), len(x)) for k in (1, 0))
    errors = np.concatenate([[0], np.cumsum(bad)]) + np.concatenate([[good.sum()], good.sum() - np.cumsum(good)])
    best = [i for i in np.flatnonzero(errors == errors.min()) if 0 < i < len(x)]
    if not best:
        return otherwise
    i = max(best, key=lambda i: x[i] - x[i - 1])
    return float((x[i] + x[i - 1]) / 2 / _STEP)


def _steps(models: list[Model], docs: list[list[str]], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Guessed language and logit, in steps, of every text by the model of the half it is not in."""
    lang, step = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
    for k in (0, 1):
        own = np.flatnonzero(halves == k)
        pooled, langs = _pool(models[2 - k], [docs[d] for d in own])
        lang[own] = langs.argmax(axis=1)
        step[own] = np.rint(np.clip(models[2 - k].logit(pooled), -30, 30) * _STEP)
    return lang, step


def _passes(n_rows: int) -> int:
    least, most = EPOCHS
    return min(most, max(least, -(-LEAST_STEPS * BATCH // n_rows)))


def fit(texts: list[str], labels: np.ndarray, langs: list[str | None], seed: int = 3) -> Model | None:
    """Train the filters, the language guess and the thresholds on texts in memory, as ``train`` does in one task."""
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    models, names = [new_model(seed) for _ in range(3)], sorted({x for x in langs if x is not None}) or [""]
    docs, halves = [split(t) for t in texts], rng.integers(0, 2, len(texts))
    which = np.array([-1 if x is None else names.index(x) for x in langs])
    counts = np.zeros((BUCKETS, len(names)))
    for epoch in range(_passes(len(docs))):
        _learn(models, docs, rng.permutation(len(docs)), labels, halves, labels.mean(), which, None if epoch else counts)
    for m in models:
        m.languages, m.lang_words = names, _log_rates(counts)
    lang, step = _steps(models, docs, halves)
    return _finish(models, [(*x, 1) for x in zip(lang.tolist(), step.tolist(), labels.tolist(), strict=True)])


class Scorer:
    """Scores whole texts."""

    def __init__(self, model: Model | None):
        self.model = model

    def __call__(self, text: str | None) -> float:
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[float]:
        m = self.model
        if m is None:
            return [0.0] * len(texts)
        pooled, langs = _pool(m, [split(t) for t in texts])
        shifted = m.logit(pooled) - m.thresholds[langs.argmax(axis=1)]
        return (1 / (1 + np.exp(-np.clip(shifted.astype(float), -30, 30)))).tolist()


_LAYOUT = (("embed", (BUCKETS, DIMENSIONS)), ("taps", (DIMENSIONS, _TAPS * FILTERS)), ("bias", (_OUTS,)), ("out", (_OUTS,)))


def _pack(models: list[Model]) -> np.ndarray:
    """Parameters and gradient sums of the models in one vector."""
    return np.concatenate([np.asarray(x, np.float32).ravel() for m in models for x in (
        *(getattr(m, k) for k, _ in _LAYOUT), *(m.seen[k] for k, _ in _LAYOUT), m.const)])


def _unpack(vector: np.ndarray) -> tuple[list[Model], np.ndarray]:
    """The three models of ``_pack``, and what follows them."""
    models, at = [], 0

    def take(shape):
        nonlocal at
        at += (size := int(np.prod(shape)))
        return vector[at - size:at].reshape(shape).copy()

    for _ in range(3):
        values = [take(shape) for _, shape in _LAYOUT]
        seen = {k: take(BUCKETS if k == "embed" else shape) for k, shape in _LAYOUT}
        models.append(Model(*values, float(take(1)[0]), seen=seen))
    return models, vector[at:]


def _sum(rows: pd.DataFrame) -> pd.DataFrame:
    """The tasks' sums of a piece of the parameters added up, over the number of rows."""
    rows = rows.sort_values("first")
    total = sum(np.frombuffer(v) for v in rows["v"])
    return pd.DataFrame({"at": [rows["at"].iloc[0]], "v": [(total / rows["n"].sum()).astype(np.float32).tobytes()]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          label_col: str = "toxic") -> Model | None:
    """Fit on every labelled row that has a text."""
    spark = docs.sparkSession
    own = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(label_col).cast("int").alias("_label")).filter(F.col("_label").isin(0, 1))
    texts = docs.filter(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    # dealt alike and merged at any size: a partition of the join is a unit, and the labels need not fit in one place
    n_units = max(1, own.count() // UNIT_ROWS)
    found = texts.repartition(n_units, "_id").join(own.repartition(n_units, "_id").hint("merge"), "_id").select(
        F.spark_partition_id().alias("unit"), F.xxhash64("_id", F.lit(17)).alias("order"), "_label", "lang", "text")
    rows = stage(found.sortWithinPartitions("order", F.xxhash64("text")), "toxic-rows")  # every pass reads them
    sizes = rows.groupBy("lang", "_label").count().collect()  # one row per language and label
    totals = [sum(r["count"] for r in sizes if r["_label"] == k) for k in (0, 1)]
    if not all(totals):
        return None
    total, share = sum(totals), totals[1] / sum(totals)
    names = sorted({r["lang"] for r in sizes if r["lang"] is not None}) or [""]
    place = {x: k for k, x in enumerate(names)}
    rows = rows.coalesce(min(max(1, total // UNIT_ROWS), MAX_TASKS))

    def read(batches):
        """Unit, words, labels, halves and languages of a few rows of one unit at a time."""
        for batch in batches:
            units = batch.column(0).to_numpy()
            cuts = np.union1d(np.flatnonzero(np.diff(units)) + 1, np.arange(0, len(units), _READ))
            for at, end in zip(cuts, np.append(cuts[1:], len(units)), strict=True):
                _, order, label, lang, text = (c.to_pylist() for c in batch.slice(at, end - at).columns)
                yield (units[at], [split(t) for t in text], np.array(label), np.array([o & 1 for o in order]),
                       np.array([place.get(x, -1) for x in lang]))

    vector = _pack([new_model() for _ in range(3)])
    for epoch in range(_passes(total)):
        shared = spark.sparkContext.broadcast(vector)  # its size is fixed by BUCKETS and DIMENSIONS

        def learn(batches, shared=shared, epoch=epoch):
            counts = None if epoch else np.zeros((BUCKETS, len(names)))
            first, n, sums = None, 0, np.zeros(len(shared.value))
            for unit, parts in groupby(read(batches), key=lambda x: x[0]):
                models, have = _unpack(shared.value)[0], 0
                for _, docs, label, halves, langs in parts:
                    _learn(models, docs, np.arange(len(docs)), label, halves, share, langs, counts)
                    have += len(docs)
                first = unit if first is None else first
                n, sums = n + have, sums + have * _pack(models).astype(float)
            if n:
                sums = sums if epoch else np.concatenate([sums, counts.ravel()])
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array(range(_CHUNKS), pa.int32()), "first": pa.array([first] * _CHUNKS, pa.int32()),
                    "n": pa.array([n] * _CHUNKS, pa.int64()), "v": pa.array([x.tobytes() for x in np.array_split(sums, _CHUNKS)], pa.binary())})

        parts = rows.mapInArrow(learn, "at int, first int, n bigint, v binary").groupBy("at").applyInPandas(_sum, "at int, v binary")
        vector = np.concatenate([np.frombuffer(r["v"], np.float32) for r in sorted(parts.collect(), key=lambda r: r["at"])])
        shared.unpersist()
        models, counts = _unpack(vector)
        if not epoch:
            log_rates = _log_rates(counts.reshape(BUCKETS, len(names)).astype(float) * total)
            vector = vector[:len(vector) - len(counts)]
    for m in models:
        m.languages, m.lang_words = names, log_rates
    fitted = spark.sparkContext.broadcast(models)

    def steps(batches):
        for _, docs, label, halves, _ in read(batches):
            lang, step = _steps(fitted.value, docs, halves)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.int32()), "step": pa.array(step, pa.int32()), "label": pa.array(label, pa.int32())})

    counted = rows.mapInArrow(steps, "lang int, step int, label int").groupBy("lang", "step", "label").count()
    out = _finish(models, [tuple(r) for r in counted.collect()])  # at most 6,001 steps of each language and label
    fitted.unpersist()
    return out


def score(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all) and ``score``."""
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is fixed by BUCKETS and DIMENSIONS

    def run(batches):
        scorer = Scorer(shared.value)
        for b in batches:
            parts = [b.column(1).slice(at, _READ).to_pylist() for at in range(0, b.num_rows, _READ)]
            scores = [s for part in parts for s in scorer.many(part)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, score double").select("row.*", "score")
