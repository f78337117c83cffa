"""Byte shards against brute force."""

import zlib

from pyspark.sql import functions as F

from sentforge.llm import sharding


def brute(rows, n):
    """(id, size, crc, shard, slot) of rows in (null first) id order; ties are equal rows or told apart by size and checksum."""
    seen = sorted((i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    whole, upto, out, slots = sum(r[2] for r in seen), 0, [], {}
    for has, i, size, crc in seen:
        shard = (2 * upto + size) * n // (2 * whole)
        out.append((i if has else None, size, crc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        upto += size
    return out


def got(out):
    return sorted(((r.id, r.size, r.text_crc32, r.shard, r.slot) for r in
                   out.select(F.col("row.doc_id").alias("id"), "size", "text_crc32", "shard", "slot").collect()), key=str)


def test_byte_shards_follow_prefix_sums(make, odd_rows):
    for n in (1, 3, 24):
        assert got(sharding.byte_shards(make(odd_rows), n)) == sorted(brute(odd_rows, n), key=str)


def test_many_rows_of_one_key_are_balanced(spark):
    rows = [(None if i % 3 else i, "same text" if i % 3 else "x" * (i % 50)) for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = sharding.byte_shards(docs, 24).cache()
    assert got(out) == sorted(brute(rows, 24), key=str)
    sizes = [r.s for r in out.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 2 * 58


def test_rows_are_kept_whole_and_written(make, odd_rows, spark, tmp_path):
    docs = make(odd_rows)
    out = sharding.byte_shards(docs, 4)
    back = out.select("row.*")
    assert back.columns == docs.columns and sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
    sharding.write_shards(out, str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert read.count() == len(odd_rows) and sorted({r._shard for r in read.collect()}) == sorted({r.shard for r in out.collect()})


def test_empty_table(make):
    assert sharding.byte_shards(make([(1, "a")]).limit(0)).count() == 0
