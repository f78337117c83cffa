"""Order-dependent readers under several split sizes."""

import random

import pytest

from sentforge.sources import splits


@pytest.fixture
def split_size(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}

    def use(size):
        for k in keys:
            spark.conf.set(k, str(size))

    yield use
    for k, v in old.items():
        spark.conf.set(k, v)


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path, split_size):
    r = random.Random(1)
    files = {"b.txt": [f"b{i} " + "x" * r.randint(0, 30) for i in range(4000)], "a.txt": [f"a{i}" for i in range(700)] + [""] * 5 + ["end"], "c.txt": []}
    for name, lines in files.items():
        (tmp_path / name).write_text("".join(x + ("\r\n" if name == "a.txt" else "\n") for x in lines))
    want = [(x, i) for i, x in enumerate(files["a.txt"] + files["b.txt"])]
    for size in (500, 4096, 1 << 27):
        split_size(size)
        got = splits.numbered_lines(spark, str(tmp_path))
        assert sorted(((x.value, x.row_id) for x in got.collect()), key=lambda x: x[1]) == want
        assert size > 500 or got.rdd.getNumPartitions() > 20


def field(r):
    kind = r.randrange(7)
    body = ["plain", "", "two\nlines", 'say ""hi""', "a,b", "x\n\n\"\"\ny,", "é\r\nü " + "z" * r.randint(0, 200)][kind]
    return body if kind in (0, 1) else f'"{body}"'


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_equal_the_one_task_reader(spark, tmp_path, split_size, end):
    r = random.Random(3)
    for name in ("one.csv", "two.csv"):
        rows = [f"{i},{field(r)},{field(r)}" for i in range(900)]
        rows[5:5] = ["", ""]
        (tmp_path / name).write_bytes((end.join(["id,a,b", *rows]) + (end if name == "one.csv" else "")).encode())
    (tmp_path / "long.csv").write_bytes(("id,a,b" + end + '7,"' + "line\n" * 3000 + f'",z{end}8,q,r').encode())
    (tmp_path / "empty.csv").write_text("")
    schema = "id int, a string, b string"
    plain = spark.read.schema(schema).options(header="true", multiLine="true", quote='"', escape='"').csv(str(tmp_path))
    want = sorted(map(str, plain.collect()))
    assert len(want) == 1802
    for size in (300, 5000, 1 << 27):
        split_size(size)
        assert sorted(map(str, splits.read_csv_records(spark, str(tmp_path), schema).collect())) == want


def test_records_without_header_and_other_separator(spark, tmp_path):
    (tmp_path / "x.tsv").write_text('1\t"a\tb\nc"\n2\td\n')
    got = splits.read_csv_records(spark, str(tmp_path / "x.tsv"), "i int, s string", header=False, sep="\t")
    assert sorted(map(tuple, got.collect())) == [(1, "a\tb\nc"), (2, "d")]
