import os
import tempfile

from pyspark.sql import functions as F

from sentforge.sources import readers as R
from sentforge.sources import sinks as S


def _tmp():
    return tempfile.mkdtemp(prefix="sentforge-io-")


def test_csv_round_trip_with_quotes_and_newlines(spark):
    d = _tmp()
    df = spark.createDataFrame([("1", 'He said "hi", then\nleft', "x")], "sno string, src string, tgt string")
    S.write_csv(df, d + "/pairs", mode="overwrite", single_file=True)
    back = R.read_csv_multiline(spark, d + "/pairs", "sno string, src string, tgt string")
    assert [tuple(r) for r in back.collect()] == [("1", 'He said "hi", then\nleft', "x")]


def test_line_csv_and_text(spark):
    d = _tmp()
    with open(d + "/in.txt", "w") as f:
        f.write('first, with comma\n"quoted line"\n\nlast\n')
    rows = [r.sentences for r in R.read_line_csv(spark, d + "/in.txt").collect()]
    assert rows == ["first, with comma", "quoted line", "last"]
    raw = [r.line for r in R.read_lines(spark, d + "/in.txt").collect()]
    assert raw == ["first, with comma", '"quoted line"', "", "last"]
    num = R.read_numbered_lines(spark, d + "/in.txt").orderBy("row_id").collect()
    assert [(r.value, r.row_id) for r in num][-1] == ("last", 3)


def test_numbered_lines_of_a_folder_equal_zip_with_index(spark):
    d = _tmp()
    for k in range(5):
        with open(f"{d}/{k}.txt", "w") as f:
            f.write("".join(f"{k}-{i}\n" for i in range(3 * k)))
    want = spark.read.text(d).rdd.zipWithIndex().map(lambda p: (p[0][0], p[1])).collect()
    got = [tuple(r) for r in R.read_numbered_lines(spark, d).orderBy("row_id").collect()]
    assert got == sorted(want, key=lambda x: x[1])


def test_whole_files_and_partitioned_write(spark):
    d = _tmp()
    for name in ("a", "b"):
        with open(f"{d}/{name}--1.html", "w") as f:
            f.write(f"<title>Page 1</title><p>{name}</p>")
    whole = R.read_whole_files(spark, d + "/*.html").collect()
    assert sorted(os.path.basename(r.filepath) for r in whole) == ["a--1.html", "b--1.html"]
    df = spark.createDataFrame([("s1", "t1", "f1.csv"), ("s2", "t2", "f2.csv"), ("s3", "t3", "f1.csv")],
                               "source_sentence string, target_sentence string, file_name string")
    S.write_partitioned(df, d + "/out", "file_name", files_per_value=2)
    back = spark.read.option("header", "true").csv(d + "/out")
    assert sorted((r.source_sentence, r.file_name) for r in back.collect()) == [
        ("s1", "f1.csv"), ("s2", "f2.csv"), ("s3", "f1.csv")]


def test_entry_and_registry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["sentence", "n"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_binary_documents_text_append_insert(spark):
    d = _tmp()
    with open(d + "/img-007.png", "wb") as f:
        f.write(b"\x89PNG\r\n")
    b = R.read_binary_files(spark, d + "/*.png").collect()
    assert bytes(b[0].content) == b"\x89PNG\r\n"
    with open(d + "/people.json", "w") as f:
        f.write('{"_id": {"oid": "5f7f"}, "firstname": "JULIA", "lastname": "50"}\n')
    docs = R.read_documents(spark, d + "/people.json", "_id struct<oid:string>, firstname string, lastname string")
    assert docs.filter(F.col("_id.oid") == "5f7f").first().firstname == "JULIA"
    S.append(docs, d + "/coll", fmt="json")
    S.append(docs, d + "/coll", fmt="json")
    assert spark.read.json(d + "/coll").count() == 2
    S.write_text(docs.select("firstname"), d + "/txt", single_file=True)
    assert [r.token for r in R.read_stage_output(spark, d + "/txt").collect()] == ["JULIA"]
    spark.sql(f"CREATE TABLE IF NOT EXISTS sf_pairs (src STRING, tgt STRING) USING parquet LOCATION '{d}/tbl'")
    S.insert_into(spark.createDataFrame([("a", "b")], "src string, tgt string"), "sf_pairs")
    assert [tuple(r) for r in spark.table("sf_pairs").collect()] == [("a", "b")]
    spark.sql("DROP TABLE sf_pairs")


def test_every_page_is_a_file(spark, tmp_path):
    """Also pages that share an id: a file each, none of them in a folder of its own."""
    import __spark_entry__ as entry

    spark.createDataFrame([(1, "<p>a"), (1, "<p>bc"), (2, "d\ne")], "page_id bigint, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    assert [tuple(r) for r in entry.queries()["scan_whole_files"](spark, str(tmp_path)).collect()] == [(3, 12)]
