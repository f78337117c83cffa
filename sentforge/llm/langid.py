"""Language identification with hyperdimensional profiles.

Every letter has a random vector of -1 and 1.  A letter n-gram is bound by
multiplying its letters' vectors, each permuted (rotated) by its place; a text's
vector bundles (adds) those of its n-grams, a language's prototype bundles those
of its training texts, and a text takes the language whose prototype has the
largest cosine with it.

Letters are lower-cased and each has its own vector, the bits of hashes of its
code point, so no alphabet is listed or folded; runs of other characters are one
word break.  The n-grams that occur in a text are bound from their letters.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; null
languages teach nothing; with no training text at all every text is ``und``;
repeated rows get equal results.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentforge.llm.common import stage

POINT_BITS = 21  # bits of a code point
DIMENSIONS = 512
NGRAM = 3
UNKNOWN = "und"
TRAIN_PER_LANGUAGE = 1000  # training texts per language: the bound on what is fitted
_BLOCK = 1 << 20  # characters turned into n-grams at a time
_BIND = 1 << 12  # n-grams bound at a time


@cache
def _letter_codes() -> np.ndarray:
    """Lower-case letter of every code point; 0 for what is no letter."""
    codes = np.zeros(0x110000, np.int64)
    for c in range(len(codes)):
        if chr(c).isalpha():
            codes[c] = ord(chr(c).lower()[0])
    return codes


def _vectors(points: np.ndarray, seed: int = 5) -> np.ndarray:
    """Vector of -1 and 1 (int8) of every letter: the bits of hashes of its code point."""
    keys = np.random.default_rng(seed).integers(0, 1 << 64, DIMENSIONS // 64, np.uint64)
    h = (points.astype(np.uint64)[:, None] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ keys
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(odd)
    h ^= h >> np.uint64(31)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return bits.astype(np.int8) * 2 - 1


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text (their code points in one integer) and their counts; empty without letters."""
    ids, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    last = np.zeros(0, np.int64)
    some = False
    for at in range(0, len(text or ""), _BLOCK):
        codes = _letter_codes()[np.frombuffer(text[at:at + _BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)]
        some = some or bool(codes.any())
        start = last if at else np.zeros(1, np.int64)
        codes = np.concatenate([start, codes])
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]  # one symbol per break
        if at + _BLOCK >= len(text):
            codes = np.concatenate([codes, np.zeros(1, np.int64)])
        if len(codes) >= NGRAM:
            grams = (codes[:-2] << (2 * POINT_BITS)) | (codes[1:-1] << POINT_BITS) | codes[2:]
            found, n = np.unique(grams, return_counts=True)
            if len(ids):
                found, place = np.unique(np.concatenate([ids, found]), return_inverse=True)
                n = np.bincount(place, weights=np.concatenate([counts, n])).astype(np.int64)
            ids, counts = found, n
        last = codes[-(NGRAM - 1):]
    return (ids, counts) if some else (ids[:0], counts[:0])


def bundle(text: str | None) -> np.ndarray:
    """The text's vector; zero without letters."""
    ids, counts = gram_counts(text)
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(ids), _BIND):
        some = ids[at:at + _BIND]
        places = [(some >> (k * POINT_BITS)) & ((1 << POINT_BITS) - 1) for k in reversed(range(NGRAM))]
        letters, which = np.unique(np.concatenate(places), return_inverse=True)
        vectors = _vectors(letters)
        grams = np.ones((len(some), DIMENSIONS), np.int8)
        for k, w in enumerate(which.reshape(NGRAM, -1)):
            grams *= np.roll(vectors, k, axis=1)[w]
        total += counts[at:at + _BIND].astype(np.float32) @ grams.astype(np.float32)
    return total


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = TRAIN_PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Unit prototypes by language, from the ``per_language`` rows of each language
    whose ids hash lowest.  Texts stay on the executors; a language's vector comes back."""
    from pyspark.sql import Window

    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    # a language's sample is cut twice, so that no language is gathered whole in one task
    order = F.xxhash64(F.col(id_col), F.lit(11))
    keys = rows.select(F.col(lang_col).alias("lang"), order.alias("o"), F.pmod(order, F.lit(256)).alias("part"))
    first = Window.partitionBy("lang", "part").orderBy("o")
    cut = keys.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= per_language)
    cut = cut.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("o"))).filter(F.col("r") <= per_language)
    limits = stage(cut.groupBy(F.col("lang").alias("_lang")).agg(F.max("o").alias("_last")), "limits")  # one row per language
    chosen = rows.join(limits, F.col(lang_col) == F.col("_lang")).filter(order <= F.col("_last")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def add_up(frames):
        sums: dict[str, np.ndarray] = {}
        for f in frames:
            for lang, text in zip(f["lang"], f["text"], strict=True):
                v = bundle(text)
                norm = np.linalg.norm(v)
                if norm:
                    sums[lang] = sums.get(lang, 0) + v / norm
        if sums:
            yield pd.DataFrame({"lang": list(sums), "v": [v.tolist() for v in sums.values()]})

    parts = chosen.mapInPandas(add_up, "lang string, v array<double>").select("lang", F.posexplode("v").alias("d", "x"))
    sums = parts.groupBy("lang", "d").agg(F.sum(F.round("x", 9)).alias("x")).collect()  # languages x dimensions
    out: dict[str, np.ndarray] = {}
    for r in sums:
        out.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["d"]] = r["x"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(out.items()) if np.linalg.norm(v)}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all), ``lang_pred`` and ``score`` (its cosine, 0 to 1)."""
    names = sorted(prototypes)
    matrix = np.array([prototypes[k] for k in names]).reshape(len(names), DIMENSIONS)
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text_col).alias("text"))

    def predict(batches):
        for b in batches:
            langs, scores = [], []
            for text in b.column(1).to_pylist():
                v = bundle(text) if text and names else np.zeros(DIMENSIONS)
                norm = np.linalg.norm(v)
                if not norm:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = matrix @ (v / norm)
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(min(max(cosines[best], 0.0), 1.0)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["row", "lang_pred", "score"])

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(predict, f"row {kind}, lang_pred string, score double").select("row.*", "lang_pred", "score")


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null ids: that of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
