"""Readers for the corpus file formats (all DataFrame readers, explicit schemas).

No schema inference anywhere (it costs an extra pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sentforge.sources.splits import read_csv_records

_QUOTE = {"quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", header: bool = False,
             encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with an explicit schema; RFC-4180 quote doubling."""
    return spark.read.schema(schema).options(sep=sep, header=str(header).lower(), encoding=encoding, **_QUOTE).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t")


def read_csv_multiline(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header row; quoted fields may contain newlines.  A large file is read by
    many tasks (see ``splits``)."""
    return read_csv_records(spark, path, schema)


def read_line_csv(spark: SparkSession, path: str, col: str = "sentences") -> DataFrame:
    """One column per line, the CSV way: the line is the record, commas stay
    in the value, surrounding quotes are removed and blank lines dropped."""
    return spark.read.schema(f"`{col}` string").options(sep="\n", **_QUOTE).csv(path)


def read_lines(spark: SparkSession, path: str, col: str = "line") -> DataFrame:
    """Raw lines (blank lines kept), plus the file each line came from."""
    return spark.read.text(path).select(F.col("value").alias(col), F.col("_metadata.file_path").alias("file_path"))


def read_stage_output(spark: SparkSession, path: str, col: str = "token") -> DataFrame:
    """Text files written by an earlier job (one value per line)."""
    return spark.read.text(path).select(F.col("value").alias(col))


def read_numbered_lines(spark: SparkSession, path: str, col: str = "value") -> DataFrame:
    """(line, 0-based global line number) of a text file or folder, in scan
    order.  A row's monotonic id is its partition and its place there; a table
    with the lines of each partition turns that into the global number.  Numbers by
    path and byte offset, whatever the scan order, come from ``splits.numbered_lines``;
    for line ids *within a document row* use ``posexplode`` instead."""
    place = F.monotonically_increasing_id()
    lines = spark.read.text(path).select(F.col("value").alias(col), place.alias("_id")).withColumn("_part", F.shiftright("_id", 33))
    sizes = lines.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return lines.join(starts, "_part").select(
        col, (F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).alias("row_id"))


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (filepath, content)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("filepath"), F.col("value").alias("content")
    )


def read_binary_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, content bytes).  Decoding is not done here."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_documents(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "json") -> DataFrame:
    """A document collection exported as JSON lines / Parquet (nested fields
    such as ``_id.oid`` stay structs)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def with_source_file(df: DataFrame, col: str = "file_name") -> DataFrame:
    """Add the file each row was read from (file-based sources only)."""
    return df.withColumn(col, F.col("_metadata.file_path"))


def register_parquet_view(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A named table over an existing Parquet location (session-scoped view)."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df
