from pyspark.sql import functions as F

from sentforge.operators import align as al
from sentforge.operators import memory as mem


def test_lookup_hits_plus_misses_is_input(spark):
    memory = mem.memory_rows(
        spark.createDataFrame([("a",), ("b",), ("e",)], "sentence string"),
        F.when(F.col("sentence") == "e", "").otherwise(F.upper("sentence")), F.lit("en"), F.lit("hi"))
    req = spark.createDataFrame([("a",), ("a",), ("c",), ("e",), (None,)], "sentence string")
    look = mem.memory_lookup(req, memory, "hi").collect()
    assert sorted((r.source_sentence, r.target_sentence, r.hit) for r in look) == [
        ("a", "A", True), ("c", None, False), ("e", None, False)]
    miss = {r.source_sentence for r in mem.memory_misses(req, memory, "hi").collect()}
    assert miss == {"c", "e"}
    new = mem.memory_rows(mem.memory_misses(req, memory, "hi"), F.concat(F.lit("t:"), "source_sentence"),
                          F.lit("en"), F.lit("hi"), text_col="source_sentence")
    up = mem.memory_upsert(memory, new)
    again = mem.memory_upsert(up, new)
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(up) == rows(again)  # idempotent
    assert {r.target_sentence for r in up.collect()} == {"A", "B", "t:c", "t:e"}


def test_keyed_merge_partial_update_and_idempotent(spark):
    base = spark.createDataFrame([({"oid": "1"}, "JULIA", "50"), ({"oid": "2"}, "Thorin", "195")],
                                 "_id struct<oid:string>, firstname string, lastname string")
    upd = spark.createDataFrame([({"oid": "2"}, "Thorin_Updated", None), ({"oid": "3"}, "Kili", "77")],
                                "_id struct<oid:string>, firstname string, lastname string")
    out = mem.keyed_merge(base, upd, "_id.oid")
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("1", "JULIA", "50"), ("2", "Thorin_Updated", "195"), ("3", "Kili", "77")]
    base2 = out.select(F.struct("oid").alias("_id"), "firstname", "lastname")
    assert sorted(tuple(r) for r in mem.keyed_merge(base2, upd, "_id.oid").collect()) == got


def test_predicates(spark):
    df = spark.createDataFrame([(3, "Valley 345"), (1, "Mountain 21"), (2, "Valley 345")], "k int, address string")
    up = {r.k: r.address for r in mem.predicate_update(df, F.col("address") == "Valley 345", "address",
                                                       "Canyon 123", "k").collect()}
    assert up == {1: "Mountain 21", 2: "Canyon 123", 3: "Valley 345"}
    assert sorted(r.k for r in mem.predicate_delete(df, F.col("address") == "Valley 345", "k").collect()) == [1, 3]
    assert sorted(r.k for r in mem.predicate_delete(df, F.col("address") == "nowhere", "k").collect()) == [1, 2, 3]


def test_language_pivot_no_row_multiplication(spark):
    clean = spark.createDataFrame([("Hello, World",), ("Unmatched",)], "sentence string")
    aligned = spark.createDataFrame(
        [("ta", "hello world", "t1"), ("ta", "hello world", "t2"), ("hi", "hello world", "h1"),
         ("hi", "hello world", "h2"), ("hi", "hello world", "h3")], "lang string, src_sentence string, tgt_sentence string")
    rows = al.language_pivot(clean, aligned).orderBy("pdf_sentence", "k").collect()
    hello = [r for r in rows if r.pdf_sentence == "Hello, World"]
    # max-per-language rows (3), k = 1..3, every translation exactly once
    assert [r.k for r in hello] == [1, 2, 3]
    assert sorted(r.ta for r in hello if r.ta) == ["t1", "t2"]
    assert sorted(r.hi for r in hello if r.hi) == ["h1", "h2", "h3"]
    assert [(r.k, r.ta, r.hi) for r in rows if r.pdf_sentence == "Unmatched"] == [(None, None, None)]
    # numbering order: (first two hex digits of sha-256, text)
    import hashlib

    order = sorted(["h1", "h2", "h3"], key=lambda t: (hashlib.sha256(t.encode()).hexdigest()[:2], t))
    assert [r.hi for r in hello] == order


def test_line_align_and_overlap(spark):
    src = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "row_id long, line string")
    tgt = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x")], "row_id long, line string")
    pairs = al.line_align(src, tgt, ["row_id"])
    assert sorted(tuple(r) for r in pairs.collect()) == [("a", "x"), ("b", "y")]
    clean = spark.createDataFrame([("a",), ("z",)], "sentence string")
    left = sorted((r.pdf_sentence, r.tgt_sentence) for r in al.overlap(clean, pairs).collect())
    assert left == [("a", "x"), ("z", None)]


def test_pair_load_malformed_metadata_and_query(spark):
    rows = [
        ("1", "B. B.", "x", "en", "hi", '{"src_filename":"a","tgt_filename":"b","label":"M"}'),
        ("2", "A much longer source sentence here.", "y", "en", "hi", '{"src_filename":"a","label":"M"}'),
        ("3", "Short one.", "z", "en", "hi", "{not json"),
    ]
    pairs = spark.createDataFrame(rows, "sno string, src string, tgt string, src_lang string, tgt_lang string, "
                                        "metadata_json string")
    out = al.pair_load(pairs, "src_filename string, tgt_filename string, label string")
    got = {r.src: (r.src_filename, r.tgt_filename, r.label, r.src_hash[:8]) for r in out.collect()}
    assert got["B. B."][:3] == ("a", "b", "M")
    assert got["A much longer source sentence here."][:3] == ("a", None, "M")   # missing field
    assert got["Short one."][:3] == (None, None, None)                          # malformed JSON
    import hashlib

    assert got["B. B."][3] == hashlib.sha256(b"B. B.").hexdigest()[:8]
    q = [tuple(r) for r in al.pair_query(out, 20, "label", "M", 10).collect()]
    assert q == [("B. B.", "x")]


def test_token_order(spark):
    from sentforge.operators.tokens import token_order

    t = spark.createDataFrame([("u.s.a",), ("mr",), ("c.r.p.c",), ("dr",)], "token string")
    assert [r.token for r in token_order(t, True).collect()] == ["dr", "mr", "u.s.a", "c.r.p.c"]
    assert [r.token for r in token_order(t, False).collect()] == ["c.r.p.c", "u.s.a", "dr", "mr"]
    rnd = [r.token for r in token_order(t, None, seed=5).collect()]
    assert sorted(rnd) == sorted(["u.s.a", "mr", "c.r.p.c", "dr"])
    assert rnd == [r.token for r in token_order(t, None, seed=5).collect()]  # seeded: repeatable
