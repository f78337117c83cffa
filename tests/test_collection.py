"""The document collection source: round trips, pushed filters, and writes that fail."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import datasource as D
from pyspark.sql import functions as F

from sentforge.sources import collection as C

SCHEMA = "_id struct<oid: string>, firstname string, age int, tags array<string>, score double"
PEOPLE = [(("a1",), "Julia", 50, ["x", None], 1.5), (("b2",), "Balin", 178, None, None), (None, None, None, [], 0.0), (("c3",), "Kili", 77, ["y"], -2.0)]


@pytest.fixture
def people(spark):
    C.register(spark)
    return spark.createDataFrame(PEOPLE, SCHEMA)


def put(df, path, mode="append"):
    df.write.format(C.NAME).mode(mode).save(path)


def load(spark, path):
    return spark.read.format(C.NAME).load(path)


def rows(df):
    return sorted(map(str, df.collect()))


def test_append_read_and_replace(spark, people, tmp_path):
    path = f"file://{tmp_path}/people"
    put(people.filter("age > 60"), path)
    put(people.filter("age <= 60 or age is null").repartition(3), path)
    put(people.limit(0), path)
    assert load(spark, path).schema == people.schema and rows(load(spark, path)) == rows(people)
    put(people, path)
    assert load(spark, path).count() == 8
    put(people.limit(1), path, "overwrite")
    assert load(spark, path).count() == 1


def test_a_failed_write_leaves_nothing(spark, people, tmp_path):
    path = str(tmp_path / "people")
    put(people, path)
    broken = spark.range(40, numPartitions=4).select(
        F.struct(F.col("id").cast("string").alias("oid")).alias("_id"), F.when(F.col("id") == 35, F.raise_error(F.lit("stop"))).otherwise(F.lit("n")).alias("firstname"),
        F.lit(1).alias("age"), F.array().cast("array<string>").alias("tags"), F.lit(1.0).alias("score"))
    with pytest.raises(PySparkException):
        put(broken, path)
    assert rows(load(spark, path)) == rows(people) and len(C.commits(path)) == 1


def test_a_job_that_dies_before_its_commit(spark, people, tmp_path):
    import pyarrow as pa

    path = str(tmp_path / "people")
    put(people, path)
    writer = C.CollectionWriter(path, people.schema, False)
    done = writer.write(iter([pa.RecordBatch.from_pydict({"firstname": ["lost"]})]))
    assert len(done.parts) == 1 and rows(load(spark, path)) == rows(people)  # parts without a commit are not seen
    writer.abort([done, None])
    assert not os.path.exists(tmp_path / "people" / "parts" / done.parts[0]["name"])

    def breaks():
        yield pa.RecordBatch.from_pydict({"firstname": ["x"] * C.PART_ROWS})
        raise OSError("lost")

    before = set(os.listdir(tmp_path / "people" / "parts"))
    with pytest.raises(OSError):
        writer.write(breaks())
    assert set(os.listdir(tmp_path / "people" / "parts")) == before


@pytest.mark.parametrize("where", [
    "firstname = 'Julia'", "age > 60", "age >= 77 and age < 178", "age in (50, 77)", "firstname is null", "_id.oid = 'b2'", "age is not null",
    "not age = 50", "age not in (50, 178)", "score > 0", "firstname like 'K%'", "age = 50 or firstname = 'Kili'", "age <=> 50", "upper(firstname) = 'KILI'",
    "age > 1000", "_id is null", "_id.oid > 'a1' and size(tags) > 0", "not age <=> 50", "age <> 50 or age is null"])
def test_pushed_filters_give_what_spark_gives(spark, people, tmp_path, where):
    path = str(tmp_path / "people")
    put(people.repartition(4), path)
    assert rows(load(spark, path).filter(where)) == rows(people.filter(where))


def test_parts_are_pruned_and_packed(spark, tmp_path):
    C.register(spark)
    path = str(tmp_path / "numbers")
    for k in range(4):
        put(spark.range(k * 1000, k * 1000 + 1000, numPartitions=2).select(F.col("id"), F.concat(F.lit(f"n{k}-"), F.col("id").cast("string")).alias("name")), path)
    schema = load(spark, path).schema

    def parts(*filters):
        reader = C.CollectionReader(path, schema)
        left = list(reader.pushFilters(list(filters)))
        return sum(len(p.names) for p in reader.partitions()), len(left)

    assert parts() == (8, 0)
    assert parts(D.EqualTo(("id",), 1700)) == (1, 0)
    assert parts(D.GreaterThan(("id",), 2499)) == (3, 0) and parts(D.LessThan(("name",), "n1")) == (2, 0)
    assert parts(D.In(("id",), (5, 3999))) == (2, 0) and parts(D.StringStartsWith(("name",), "n1")) == (8, 1)
    assert len(C.CollectionReader(path, schema).partitions()) == 1  # small parts share a partition
    assert load(spark, path).filter("id between 900 and 1100").agg(F.sum("id")).first()[0] == sum(range(900, 1101))


def test_no_commits(spark, tmp_path):
    C.register(spark)
    assert spark.read.format(C.NAME).schema("a int").load(str(tmp_path)).count() == 0
    with pytest.raises(PySparkException):
        load(spark, str(tmp_path)).count()
