import random
import re

from pyspark.sql import functions as F

from sentforge.operators.tokens import (
    DEFAULT_RULES,
    RULE4_INTENT,
    RULE4_LITERAL,
    effective_rules,
    jvm_rule,
    negative_tokens,
)

RULES = effective_rules(DEFAULT_RULES) + [RULE4_LITERAL]


def _spark_matches(spark, tokens, rule):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string")
    rows = df.select("i", F.regexp_extract_all("t", F.lit(jvm_rule(rule)), 0).alias("m")).collect()
    return {r["i"]: list(r["m"]) for r in rows}


def test_jvm_forms_match_python_on_random_tokens(spark):
    rnd = random.Random(7)
    alphabet = "ab1.Z.x-{0-4}"
    tokens = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    tokens += ["c.r.p.c....", "a.b.c", "12.02.2019", "mr.", "63.", "u.s.a.", "e.g", "x", "...", "foo.bar.baz.",
               "W.E.F.", "end.next", "abcdefg.h.", "ab1.", "a{0-4}.b{0-4}."]
    for rule in RULES:
        got = _spark_matches(spark, tokens, rule)
        for i, t in enumerate(tokens):
            want = [m.group() for m in re.finditer(rule, t, re.IGNORECASE)]
            assert got[i] == want, (rule, t, got[i], want)


def test_fixture_table(spark):
    # FIXTURES section 4, rules 1, 2, 3, 5 (rule 4 is covered by the random test)
    cases = {
        "c.r.p.c....": (["c.r.p.c...."], ["c.r.p"], ["c.r.p.c."], ["c.r.p.c...."]),
        "a.b.c": (["a.b."], ["a.b.c"], ["a.b."], ["a.b."]),
        "12.02.2019": (["12.02."], ["12.02.2019"], ["12.02."], ["12.02."]),
        "mr.": ([], [], [], ["mr."]),
        "u.s.a.": (["u.s."], ["u.s.a"], ["u.s.a."], ["u.s.a."]),
        "e.g": (["e.g"], [], [], ["e."]),
        "end.next": (["end.next"], [], [], ["end."]),
    }
    rules = [DEFAULT_RULES[0], DEFAULT_RULES[1], DEFAULT_RULES[2], DEFAULT_RULES[4]]
    toks = list(cases)
    for k, rule in enumerate(rules):
        got = _spark_matches(spark, toks, rule)
        for i, t in enumerate(toks):
            assert got[i] == cases[t][k], (rule, t)


def test_long_tokens_do_not_crash_the_executor(spark):
    toks = ["." * 5000, "a." * 50000, "ab.c" * 20000 + "."]
    for rule in RULES:
        got = _spark_matches(spark, toks, rule)
        assert len(got) == 3


def test_negative_tokens_filters(spark):
    text = ["Mr. Rao met Dr. Sen at the U.S.A. office on 12.02.2019.", "See e.g. c.r.p.c.... too", None]
    df = spark.createDataFrame([(t,) for t in text], "text string")
    default = spark.createDataFrame([("e.g",)], "t string")
    out = {r.token for r in negative_tokens(df, default).collect()}
    assert "u.s.a" in out            # trailing period dropped
    assert "mr" not in out           # 'mr.' has length 3: bound is strict
    assert "dr" not in out
    assert "12.02.2019" in out
    assert "e.g" not in out          # removed as a default token
    assert {"it", "him", "adv"} <= out  # extra tokens, final period dropped
    strict = {r.token for r in negative_tokens(df, default, strict=True).collect()}
    assert {"it.", "him.", "adv."} <= strict


def test_rule4_intent_vs_literal():
    assert re.fullmatch(RULE4_INTENT, "it.mr.") and not re.fullmatch(RULE4_LITERAL, "it.")
