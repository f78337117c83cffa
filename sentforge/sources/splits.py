"""Text files whose order matters, read by many tasks.

Every line comes with its file, the start of the split it was read from, and its
place in the scan; (file, split, place) is the order of the lines, whatever the
splits.  What depends on all lines above is settled in two levels: each split
reports a few numbers, their running sums (a row per split) say how it begins,
and the rest happens inside the splits.

``numbered_lines``  line counts give the number of a split's first line.

``read_csv_records``  quoted fields may hold line breaks, so a split cannot know
whether it begins inside quotes.  Each split reports the parity of its quote
characters and how many lines would begin a record for either start; a running
exclusive-or settles which start is true.  Only records that cross a border of
splits are gathered by a shuffle of their own.

Both passes scan the same files with the same settings, which Spark deals to the
same partitions.  Gzip files have one split.  Quotes inside a field must be
doubled, and a quote in an unquoted field is not allowed (RFC 4180); a file with
an odd number of quotes has one last record that reaches to its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def split_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``split`` (its first byte), ``at`` (increasing in a split) and ``line``, cut at line feeds."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def numbered_lines(spark: SparkSession, path: str | list[str], col: str = "value") -> DataFrame:
    """``col``, ``file`` and ``row_id``: 0-based over all files in path order, the same for all split sizes."""
    lines = split_lines(spark, path)
    splits = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    starts = splits.select("file", "split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return lines.join(starts, ["file", "split"]).select(
        F.regexp_replace("line", "\r$", "").alias(col), "file", (F.col("start") + F.col("at") - F.col("first")).alias("row_id"))


def _ddl(schema: StructType | str) -> str:
    return schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def csv_records(lines: DataFrame, quote: str = '"') -> DataFrame:
    """Records of quoted text from ``split_lines``: ``file``, ``record`` (0-based in its file) and ``text``."""
    block = Window.partitionBy("file", "split").orderBy("at")
    above, upto = block.rowsBetween(Window.unboundedPreceding, -1), block.rowsBetween(Window.unboundedPreceding, 0)
    odd = F.pmod(F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit(""))), F.lit(2))
    marked = lines.withColumn("odd", odd).withColumn("inside", F.pmod(F.coalesce(F.sum("odd").over(above), F.lit(0)), F.lit(2)).cast("int"))
    # what a split reports: its parity, and the records that begin in it, for either start
    splits = marked.groupBy("file", "split").agg(
        F.pmod(F.sum("odd"), F.lit(2)).alias("parity"), F.sum(1 - F.col("inside")).alias("begun_0"), F.sum("inside").alias("begun_1"),
        F.min_by(F.col("line").endswith("\r"), "at").alias("returns"))
    order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("entry", F.pmod(F.coalesce(F.sum("parity").over(order), F.lit(0)), F.lit(2)).cast("int"))
    splits = splits.withColumn("begun", F.when(F.col("entry") == 0, F.col("begun_0")).otherwise(F.col("begun_1")))
    # a file whose first line ends in a carriage return and a line feed has such line ends, also in its quoted fields
    returns = F.first("returns").over(Window.partitionBy("file").orderBy("split"))
    splits = splits.select("file", "split", "entry", "begun", F.coalesce(F.sum("begun").over(order), F.lit(0)).alias("before"), returns.alias("returns"))
    settled = marked.join(splits, ["file", "split"]).withColumn("line", F.when(F.col("returns"), F.regexp_replace("line", "\r$", "")).otherwise(F.col("line")))
    begins = F.when(F.col("inside") == F.col("entry"), 1).otherwise(0)
    settled = settled.withColumn("record", F.col("before") + F.sum(begins).over(upto) - 1)
    text = lambda key, value: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value]), "\n")
    crosses = (F.col("record") < F.col("before")) | (F.col("record") == F.col("before") + F.col("begun") - 1)
    pieces = settled.groupBy("file", "split", "record", crosses.alias("crosses")).agg(text("at", "line").alias("text"))
    whole = pieces.filter("crosses").groupBy("file", "record").agg(text("split", "text").alias("text"))
    return pieces.filter("not crosses").select("file", "record", "text").unionByName(whole)


def read_csv_records(spark: SparkSession, path: str | list[str], schema: StructType | str, header: bool = True, sep: str = ",") -> DataFrame:
    """Delimited text whose quoted fields may hold line breaks, each file read by many tasks; blank records are left out."""
    records = csv_records(split_lines(spark, path)).filter((F.col("text") != "") & (F.col("record") > (0 if header else -1)))
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    return records.select(F.from_csv("text", _ddl(schema), options).alias("r")).select("r.*")
