"""The bucketed store: results against a dictionary, and the plans it is built for."""

import random

import pytest
from pyspark.errors import AnalysisException

from sentforge.operators import memory as mem
from sentforge.sources import memory_store as store

SCHEMA = "key string, source_sentence string, target_sentence string, source_language string, target_language string, at int"


def rows_of(spark, items):
    return spark.createDataFrame([(k, f"s{k}", t, "en", "hi", at) for k, t, at in items], SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_puts_and_compaction_equal_a_dictionary(spark, tmp_path):
    r = random.Random(1)
    want, kept = {}, None
    for step in range(5):
        items = [(f"k{r.randrange(60)}", r.choice(["a", "b", "", None]) and f"{r.random()}", at) for at in range(40)]
        rows = rows_of(spark, items + [(None, "lost", 0)])
        for k, t, _ in sorted(items, key=lambda x: x[2]):
            want[k] = t
        if kept is None:
            kept = store.create(spark, str(tmp_path), mem.dedupe_by_key(rows, "at"), buckets=4)
        else:
            kept = store.put(kept, rows, order_col="at", max_layers=3)
        got = {x.key: x.target_sentence for x in store.scan(kept).collect()}
        assert got == want and store.scan(kept).columns == list(mem.MEMORY_COLUMNS)
        assert len(kept.layers) <= 3
    again = store.open_store(spark, str(tmp_path))
    assert again == kept and {x.key for x in store.scan(again).collect()} == set(want)


def test_older_versions_stay_readable(spark, tmp_path):
    one = store.create(spark, str(tmp_path), rows_of(spark, [("a", "1", 0)]).drop("at"), buckets=2)
    two = store.put(one, rows_of(spark, [("a", "2", 0)]))
    store.compact(two)
    read = lambda s: [(x.key, x.target_sentence) for x in store.scan(s).collect()]
    assert read(one) == [("a", "1")] and read(store.open_store(spark, str(tmp_path), 1)) == [("a", "2")]
    assert read(store.open_store(spark, str(tmp_path))) == [("a", "2")]
    with pytest.raises(ValueError):
        store.open_store(spark, str(tmp_path), 99)


def test_two_writers_of_a_version(spark, tmp_path):
    one = store.create(spark, str(tmp_path), rows_of(spark, [("a", "1", 0)]).drop("at"), buckets=2)
    store.put(one, rows_of(spark, [("a", "2", 0)]))
    with pytest.raises(AnalysisException):
        store.put(one, rows_of(spark, [("a", "3", 0)]))  # the version exists: the second put is not seen
    assert [x.target_sentence for x in store.scan(store.open_store(spark, str(tmp_path))).collect()] == ["2"]


def test_put_writes_its_rows_only(spark, tmp_path):
    one = store.create(spark, str(tmp_path), rows_of(spark, [(f"k{i}", "x", 0) for i in range(3000)]).drop("at"), buckets=2)
    two = store.put(one, rows_of(spark, [("k1", "y", 0), ("n", "z", 0)]))
    assert spark.read.parquet(f"{tmp_path}/{two.layers[1]}").count() == 2


def test_plans_use_the_buckets(spark, tmp_path, no_broadcast):
    kept = store.create(spark, str(tmp_path), rows_of(spark, [(f"hi_{i}", "x", 0) for i in range(100)]).drop("at"), buckets=4)
    kept = store.put(kept, rows_of(spark, [("hi_1", "y", 0)]))
    asked = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "sentence string")
    found = store.lookup(kept, asked, "hi")
    text = plan(found)
    # the distinct requests, and their way into the buckets: nothing on the side of the memory
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Bucketed: true") == 2
    assert "Exchange" not in plan(store.scan(kept))
    assert plan(store.get(kept, "hi_1")).count("SelectedBucketsCount: 1 out of 4") == 2
    assert [tuple(x) for x in store.get(kept, "hi_1").select("key", "target_sentence").collect()] == [("hi_1", "y")]
    assert store.get(kept, "none").count() == 0


def test_lookup_equals_the_join(spark, tmp_path):
    source = spark.createDataFrame([(t, g) for t, g in [("one", "1"), ("two", ""), ("three", None), ("four", "4")]], "sentence string, g string")
    from pyspark.sql import functions as F

    rows = mem.memory_rows(source, F.col("g"), F.lit("en"), F.lit("hi"))
    kept = store.create(spark, str(tmp_path), rows, buckets=3)
    asked = spark.createDataFrame([("one",), ("two",), ("three",), ("five",), (None,), ("one",)], "sentence string")
    want = sorted(mem.memory_lookup(asked, rows, "hi").collect())
    assert sorted(store.lookup(kept, asked, "hi").collect()) == want
    fixed = mem.memory_rows(source.filter("sentence = 'two'"), F.lit("2"), F.lit("en"), F.lit("hi"))
    hit = {x.source_sentence: x.target_sentence for x in store.lookup(store.put(kept, fixed), asked, "hi").collect() if x.hit}
    assert hit == {"one": "1", "two": "2"}


def test_empty_store(spark, tmp_path):
    none = rows_of(spark, []).drop("at")
    kept = store.put(store.create(spark, str(tmp_path), none, buckets=2), rows_of(spark, []))
    assert store.scan(kept).count() == 0 and store.get(kept, "x").count() == 0
    assert store.lookup(kept, spark.createDataFrame([("a",)], "sentence string"), "hi").filter("hit").count() == 0


def test_rows_reach_their_bucket_in_one_shuffle(spark):
    from pyspark.sql import functions as F

    from sentforge.operators import memory as mem
    from sentforge.sources import memory_store as ms

    lines = spark.createDataFrame([("a", "en"), ("a", "hi"), ("b", "en")], "sentence string, lang string")
    rows = ms._by_bucket(mem.memory_rows(lines, F.concat(F.lit("t "), F.col("sentence")), F.col("lang"), F.lit("hi"), unique=False), 4)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted((r.source_sentence, r.source_language) for r in rows.collect()) == [("a", "hi"), ("b", "en")]
