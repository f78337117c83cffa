"""A translation memory on files: bucketed, sorted layers with merge-on-read.

A store is a folder.  ``layer-<n>`` holds rows hashed by key into a fixed number
of buckets and sorted by key inside them; ``log/version=<v>`` names the layers of
a version, oldest first.  A put writes its rows as one more layer and nothing
else; of several rows with a key the newest layer's counts.  A compaction writes
all layers as one.  A version is there when its log entry is, so a job that fails
before leaves the store as it was, and readers keep the version they opened.

Buckets carry through to the plans: a lookup shuffles its requests once into the
buckets and joins every layer in place, a point get reads one bucket of each
layer, and a compaction joins and writes without any shuffle.  Buckets should be
chosen so that one fits a task (``buckets`` is a parameter of ``create``; to
change it, create a store from ``scan``).

Edge cases: rows with a null key are not stored; of equal keys in one put the
largest (order, translation, ...) is kept, as in ``dedupe_by_key``; an empty put
adds an empty layer; a key that is not there gives no row.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentforge.functions.text import memory_key
from sentforge.operators.memory import MEMORY_COLUMNS, dedupe_by_key

BUCKETS = 16
MAX_LAYERS = 8  # a put beyond so many layers compacts
_VALUES = [c for c in MEMORY_COLUMNS if c != "key"]
_COLUMNS = ", ".join(f"{c} string" for c in MEMORY_COLUMNS)


@dataclass(frozen=True)
class MemoryStore:
    """A version of a store: its folder, version number, buckets and layer folders, oldest first."""

    spark: SparkSession
    path: str
    version: int
    buckets: int
    layers: tuple[str, ...]


def _log(spark: SparkSession, path: str, version: int, buckets: int, layers: list[str]) -> MemoryStore:
    rows = [(i, x, buckets) for i, x in enumerate(layers)]
    spark.createDataFrame(rows, "place int, layer string, buckets int").coalesce(1).write.mode("errorifexists").parquet(f"{path}/log/version={version}")
    return MemoryStore(spark, path, version, buckets, tuple(layers))


def _write_layer(rows: DataFrame, path: str, buckets: int) -> str:
    """One file per bucket: rows reach the tasks in the buckets' own partitioning."""
    name = f"layer-{uuid.uuid4().hex}"
    rows.select(*MEMORY_COLUMNS).write.bucketBy(buckets, "key").sortBy("key").option("path", f"{path}/{name}").option("compression", "zstd").format("parquet").saveAsTable(_table(path, name))
    return name


def _table(path: str, layer: str) -> str:
    return layer.replace("-", "_")


def _layer(store: MemoryStore, layer: str) -> DataFrame:
    """A layer as a table with its buckets; a session that did not write it declares it first."""
    name = _table(store.path, layer)
    if not store.spark.catalog.tableExists(name):
        store.spark.sql(f"CREATE TABLE {name} ({_COLUMNS}) USING parquet CLUSTERED BY (key) SORTED BY (key) INTO {store.buckets} BUCKETS "
                        f"LOCATION '{store.path}/{layer}'")
    return store.spark.table(name)


def _by_bucket(rows: DataFrame, buckets: int, order_col: str | None = None) -> DataFrame:
    """One row per key, shuffled once: the buckets' own partitioning serves the choice of the row, too."""
    return dedupe_by_key(rows.filter("key is not null").repartition(buckets, "key"), order_col)


def create(spark: SparkSession, path: str, rows: DataFrame, buckets: int = BUCKETS) -> MemoryStore:
    """A new store of ``rows`` (``MEMORY_COLUMNS``) in the empty folder ``path``, which all executors see."""
    path = path.rstrip("/")
    return _log(spark, path, 0, buckets, [_write_layer(_by_bucket(rows, buckets), path, buckets)])


def open_store(spark: SparkSession, path: str, version: int | None = None) -> MemoryStore:
    """The newest version of a store, or the given one."""
    path = path.rstrip("/")
    log = spark.read.parquet(f"{path}/log")
    if version is None:
        version = log.agg(F.max("version")).first()[0]
    rows = log.filter(F.col("version") == version).orderBy("place").collect()  # a row per layer, at most MAX_LAYERS + 1
    if not rows:
        raise ValueError(f"no version {version} in {path}")
    return MemoryStore(spark, path, version, rows[0]["buckets"], tuple(r["layer"] for r in rows))


def put(store: MemoryStore, rows: DataFrame, order_col: str | None = None, max_layers: int = MAX_LAYERS) -> MemoryStore:
    """A version in which ``rows`` replace those of equal keys: only ``rows`` are written."""
    layer = _write_layer(_by_bucket(rows, store.buckets, order_col), store.path, store.buckets)
    new = _log(store.spark, store.path, store.version + 1, store.buckets, [*store.layers, layer])
    return compact(new) if len(new.layers) > max_layers else new


def _merged(store: MemoryStore) -> DataFrame:
    """All layers joined bucket by bucket; the newest row of a key wins as a whole."""
    whole = None
    for layer in store.layers:
        rows = _layer(store, layer).select("key", F.struct(*_VALUES).alias("_new"))
        if whole is None:
            whole = rows.withColumnRenamed("_new", "_row")
        else:
            whole = whole.join(rows, "key", "full_outer").select("key", F.coalesce("_new", "_row").alias("_row"))
    return whole.select("key", "_row.*").select(*MEMORY_COLUMNS)


def scan(store: MemoryStore) -> DataFrame:
    """Every row of this version."""
    return _merged(store)


def compact(store: MemoryStore) -> MemoryStore:
    """A version with the same rows in one layer; the older layers stay for readers of older versions."""
    return _log(store.spark, store.path, store.version + 1, store.buckets, [_write_layer(_merged(store), store.path, store.buckets)])


def get(store: MemoryStore, key: str) -> DataFrame:
    """The row of one key: one bucket of each layer is read."""
    found = None
    for place, layer in enumerate(store.layers):
        rows = _layer(store, layer).filter(F.col("key") == key).withColumn("_place", F.lit(place))
        found = rows if found is None else found.unionByName(rows)
    newest = F.max(F.struct("_place", *MEMORY_COLUMNS)).alias("_r")  # a key has a row per layer at most
    return found.groupBy("key").agg(newest).select("_r.*").select(*MEMORY_COLUMNS)


def get_sentence(store: MemoryStore, sentence: str, target_language: str) -> DataFrame:
    """The stored row of a sentence."""
    key = store.spark.range(1).select(memory_key(F.lit(target_language), F.lit(sentence))).first()[0]
    return get(store, key)


def lookup(store: MemoryStore, requests: DataFrame, target_language: str, text_col: str = "sentence") -> DataFrame:
    """Distinct requests with ``target_sentence`` and ``hit``; only the requests are shuffled.

    A missing key, or a null or empty text in the newest row of a key, is a miss."""
    r = requests.select(F.col(text_col).alias("source_sentence")).filter(F.col("source_sentence").isNotNull()).distinct()
    found = r.withColumn("key", memory_key(F.lit(target_language), F.col("source_sentence"))).repartition(store.buckets, "key").select(
        "key", "source_sentence", F.lit(None).cast("struct<target_sentence: string>").alias("_row"))
    for layer in store.layers:
        rows = _layer(store, layer).select("key", F.struct("target_sentence").alias("_new"))
        found = found.join(rows, "key", "left").select("key", "source_sentence", F.coalesce("_new", "_row").alias("_row"))
    text = F.when(F.col("_row.target_sentence") != "", F.col("_row.target_sentence"))
    return found.select("source_sentence", text.alias("target_sentence"), text.isNotNull().alias("hit"))
