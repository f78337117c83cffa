from pyspark.sql import functions as F

from sentforge.operators.sentences import numbered_lines, sentence_split


def _split(spark, lines, abbr):
    df = spark.createDataFrame([(1, i, l) for i, l in enumerate(lines)], "doc_id long, line_no int, line string")
    a = spark.createDataFrame([(x,) for x in abbr], "token string") if abbr is not None else None
    rows = sentence_split(df, a).orderBy("line_no", "sentence_no").collect()
    return [(r.line_no, r.sentence) for r in rows]


def test_abbreviation_does_not_end_sentence(spark):
    got = _split(spark, ["Mr. Rao met Dr. Sen. They left!  Next  one"], ["mr", "dr"])
    assert [s for _, s in got] == ["Mr. Rao met Dr. Sen.", "They left!", "Next one"]


def test_without_abbreviations_every_period_ends(spark):
    got = _split(spark, ["Mr. Rao met (e.g. him)."], None)
    assert [s for _, s in got] == ["Mr.", "Rao met (e.g.", "him)."]


def test_stem_ignores_leading_punctuation_and_closers(spark):
    got = _split(spark, ['He said "(e.g. this" and stopped." Then ok? yes'], ["e.g"])
    assert [s for _, s in got] == ['He said "(e.g. this" and stopped."', "Then ok?", "yes"]


def test_no_word_lost(spark):
    lines = ["A b. c d! e f? g", "", "   ", "x.y. z. w", "Mr. Mr. Mr. end."]
    got = _split(spark, lines, ["mr", "x.y"])
    for i, line in enumerate(lines):
        words = line.split()
        rebuilt = " ".join(s for ln, s in got if ln == i).split()
        assert rebuilt == words


def test_numbered_lines(spark):
    df = spark.createDataFrame([(7, "a\nb\n\nc")], "doc_id long, text string")
    rows = numbered_lines(df).orderBy("line_no").collect()
    assert [(r.line_no, r.line) for r in rows] == [(0, "a"), (1, "b"), (2, ""), (3, "c")]


def test_shuffle_path_equals_broadcast_path(spark):
    lines = ["Mr. Rao met Dr. Sen. They left!", "No stem here? none", "e.g. this and u.s.a. that. end",
             "Plain line without boundary"]
    df = spark.createDataFrame([(1, i, l) for i, l in enumerate(lines)], "doc_id long, line_no int, line string")
    abbr = spark.createDataFrame([("mr",), ("dr",), ("e.g",), ("u.s.a",)], "token string")
    fast = sorted(tuple(r) for r in sentence_split(df, abbr).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        slow = sorted(tuple(r) for r in sentence_split(df, abbr).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fast == slow
    assert ("Mr. Rao met Dr. Sen.",) in [(r[3],) for r in fast]
