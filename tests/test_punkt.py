"""The learned sentence model on texts whose sentences are known."""

import math
import random

import pytest
from pyspark.sql import functions as F

from sentforge.operators import punkt

NAMES = "Smith Jones Baker Mason Carter Miller Turner Fisher".split()
NOUNS = "river house garden market window street letter bridge".split()
VERBS = "sees likes finds paints sells keeps".split()


def sentence(r):
    kind = r.randrange(4)
    if kind == 0:
        return f"The {r.choice(NOUNS)} of dr. {r.choice(NAMES)} has a {r.choice(NOUNS)}."
    if kind == 1:
        return f"He {r.choice(VERBS)} the {r.choice(NOUNS)} near no. {r.randint(2, 90)} and the {r.choice(NOUNS)}."
    if kind == 2:
        return f"The prof. {r.choice(VERBS)} a {r.choice(NOUNS)}, and he {r.choice(VERBS)} it!"
    return f"She asks \"is the {r.choice(NOUNS)} here\" and the i.e. {r.choice(NOUNS)} near a {r.choice(NOUNS)}."


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(2)
    truth = [[sentence(r) for _ in range(r.randint(1, 6))] for _ in range(600)]
    rows = [(i, 0, " ".join(x)) for i, x in enumerate(truth)] + [(9000, 0, None), (9001, 0, ""), (9002, 0, "  \t ")]
    return truth, spark.createDataFrame(rows, "doc_id bigint, line_no int, line string").repartition(4)


def test_abbreviations_are_learned(corpus):
    found = {r.kind: r for r in punkt.abbreviations(punkt.word_counts(corpus[1])).collect()}
    assert {"dr", "prof", "i.e", "no"} >= set(found) and {"dr", "i.e"} <= set(found)
    assert all(r.score >= punkt.ABBREVIATION_SCORE and r.with_period > 0 for r in found.values())


def test_scores_follow_the_formula(corpus):
    counts = punkt.word_counts(corpus[1])
    words = [(w, w.rstrip('"')) for line in corpus[0] for s in line for w in s.split()]
    n, dots = len(words), sum(w.endswith(".") for _, w in words)
    k = sum(w == "dr." for _, w in words)
    m = k + sum(w == "dr" for _, w in words)
    rate = dots / n
    ratio = -2 * (k * math.log(rate) + (m - k) * math.log(1 - rate) - k * math.log(0.99) - (m - k) * math.log(0.01))
    got = punkt.abbreviations(counts).filter("kind = 'dr'").first()
    assert got.with_period == k and got.without_period == m - k
    assert got.score == pytest.approx(ratio * math.exp(-2 - (m - k) * math.log(2)), rel=1e-9)
    assert counts.agg(F.sum("n")).first()[0] == n


def test_starters_are_learned(corpus):
    counts = punkt.word_counts(corpus[1])
    found = {r.kind for r in punkt.sentence_starters(counts, punkt.abbreviations(counts)).collect()}
    assert {"she", "the"} <= found and not found & {n.lower() for n in NAMES}


def test_collocations_need_a_doubtful_period(spark):
    lines = ["He met no. seven of them. All was well."] * 30 + ["It is on. seven may go."] * 3
    counts = punkt.word_counts(spark.createDataFrame([(x,) for x in lines], "line string"))
    known = spark.createDataFrame([("no",)], "kind string")
    empty = spark.createDataFrame([], "kind string")
    found = punkt.collocations(counts, known, empty).collect()
    assert [(r["first"], r["second"], r["n_both"]) for r in found] == [("no", "seven", 30)]


def test_sentences_are_restored(corpus):
    truth, lines = corpus
    out = punkt.punkt_split(lines, punkt.train(lines)).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.doc_id, r.sentence_no)):
        got.setdefault(r.doc_id, []).append(r.sentence)
    assert set(got) == set(range(len(truth)))  # null and blank lines have no sentence
    right = sum(got[i] == x for i, x in enumerate(truth))
    assert right / len(truth) > 0.9
    assert all(" ".join(got[i]) == " ".join(x) for i, x in enumerate(truth))


def test_given_abbreviations_are_known(spark):
    lines = spark.createDataFrame([(1, 0, "She saw adv. Rao here. Then she left.")], "doc_id bigint, line_no int, line string")
    extra = spark.createDataFrame([("adv",)], "token string")
    split = lambda model: [r.sentence for r in punkt.punkt_split(lines, model).orderBy("sentence_no").collect()]
    assert split(punkt.train(lines, extra)) == ["She saw adv. Rao here.", "Then she left."]
    assert split(punkt.train(lines)) == ["She saw adv.", "Rao here.", "Then she left."]


def test_counts_are_folded_before_the_shuffle(corpus):
    plan = punkt.orthography(punkt.word_counts(corpus[1]), corpus[1].select(F.lit("dr").alias("kind")).limit(1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text


def test_no_lines(spark):
    none = spark.createDataFrame([], "doc_id bigint, line_no int, line string")
    model = punkt.train(none)
    assert punkt.punkt_split(none, model).count() == 0 and model.orthography.count() == 0
