"""Writers.  Single-file output (``coalesce(1)``) is opt-in: it funnels the
whole result through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _one(df: DataFrame, single_file: bool) -> DataFrame:
    return df.coalesce(1) if single_file else df


def write_text(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """One string column -> text files (one value per line)."""
    _one(df, single_file).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists",
              single_file: bool = False) -> None:
    _one(df, single_file).write.mode(mode).option("header", str(header).lower()).options(
        quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows to a collection stored as files."""
    df.write.mode("append").format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, by: str, fmt: str = "csv", files_per_value: int = 1,
                      mode: str = "overwrite") -> None:
    """One folder per value of ``by``.  Rows are shuffled by (value, salt) so
    a value holding a large share of the rows is written by
    ``files_per_value`` tasks; the salt is a hash of the row (deterministic on
    recomputation)."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(max(files_per_value, 1)))
    out = df.repartition(F.col(by), salt)
    w = out.write.mode(mode).partitionBy(by).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true").options(quote='"', escape='"')
    w.save(path)


def write_balanced(df: DataFrame, path: str, by: str, size: Column | None = None, target_bytes: int = 128 << 20, fmt: str = "parquet",
                   only: bool = False) -> None:
    """One folder per value of ``by``, in files of about ``target_bytes`` (by ``size``, a row's bytes; a row counts 1
    without it).  Each value gets as many salts as its bytes need, so a value with most of the rows is written by
    many tasks; rows are dealt by ranges of (value, salt).  With ``only``, folders of values that are not in ``df``
    stay as they are; otherwise the whole folder is replaced."""
    rows = df.withColumn("_size", size if size is not None else F.lit(1).cast("bigint"))
    files = rows.groupBy(F.col(by).alias("_by")).agg(F.greatest(F.ceil(F.sum("_size") / F.lit(target_bytes)), F.lit(1)).alias("_files"))
    salted = rows.join(files, F.col(by).eqNullSafe(F.col("_by"))).withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_files")))
    writer = salted.repartitionByRange(by, "_salt").select(*df.columns).write.mode("overwrite").partitionBy(by).format(fmt)
    if only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.options(header="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    writer.save(path)


def insert_into(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT ...`` (positional, like SQL)."""
    df.write.insertInto(table)


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows under a total order (``show`` without printing)."""
    return df.orderBy(*(order_by or df.columns)).limit(n)
