"""An append-only document collection as a Spark data source (``sentforge_collection``).

A collection is a folder with ``parts`` (Parquet files of documents, nested
fields included) and ``commits`` (one small JSON file per write, naming its parts
with row counts and the least and greatest value of their plain columns).

Writing has two phases: tasks write parts that nobody sees and report them; the
driver, once every task is done, publishes one commit file by renaming it into
place.  A write that fails, or dies half-way, leaves no commit and so nothing
visible; its reported parts are deleted.  Reading lists the commits, drops parts
that the pushed filters exclude by their value ranges, packs the rest into
partitions of similar size, and applies the pushed filters to the rows.

    collection.register(spark)
    df.write.format("sentforge_collection").mode("append").save(path)
    spark.read.format("sentforge_collection").load(path).filter("firstname = 'Julia'")

Comparisons with literals and null tests are pushed, also on nested fields; the
rest stays with Spark.  ``mode("overwrite")`` publishes a commit that replaces
all earlier ones.  Edge cases: an empty write publishes a commit without parts
(its schema counts); reading a folder without commits needs a schema and gives
no rows; a document without a field of the schema has null there.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

NAME = "sentforge_collection"
PART_ROWS = 50_000
PART_BYTES = 64 << 20
PARTITION_ROWS = 100_000  # small parts are read together up to so many rows


def register(spark: SparkSession) -> None:
    """Make the source known to the session, with filters pushed into it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CollectionSource)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    fs, root = pafs.FileSystem.from_uri(path)
    return fs, root.rstrip("/")


def commits(path: str) -> list[dict]:
    """The commits that count, oldest first: all since the last one that replaces."""
    fs, root = _open(path)
    found = fs.get_file_info(pafs.FileSelector(f"{root}/commits", allow_not_found=True))
    names = sorted(f.path for f in found if f.base_name.endswith(".json") and not f.base_name.startswith("."))
    out: list[dict] = []
    for name in names:
        with fs.open_input_stream(name) as f:
            commit = json.loads(f.read())
        out = [commit] if commit["replace"] else [*out, commit]
    return out


class CollectionSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def _path(self) -> str:
        return self.options["path"]

    def schema(self) -> StructType:
        known = commits(self._path())
        if not known:
            raise ValueError(f"{self._path()} has no commits: name a schema")
        return StructType.fromJson(known[-1]["schema"])

    def reader(self, schema: StructType) -> CollectionReader:
        return CollectionReader(self._path(), schema)

    def writer(self, schema: StructType, overwrite: bool) -> CollectionWriter:
        return CollectionWriter(self._path(), schema, overwrite)


# ------------------------------------------------------------------ write ----
@dataclass
class Written(D.WriterCommitMessage):
    parts: list[dict]


def _ranges(batches: list[pa.RecordBatch]) -> dict:
    """Least and greatest value of the plain columns of a part."""
    out = {}
    for f in batches[0].schema:
        if pa.types.is_integer(f.type) or pa.types.is_string(f.type) or pa.types.is_boolean(f.type):
            found = [pc.min_max(b.column(f.name)).as_py() for b in batches]
            values = [v for x in found for v in (x["min"], x["max"]) if v is not None]
            out[f.name] = [min(values), max(values)] if values else [None, None]
    return out


class CollectionWriter(D.DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.path)
        fs.create_dir(f"{root}/parts", recursive=True)
        parts: list[dict] = []
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            if held:
                name = f"{uuid.uuid4().hex}.parquet"
                with fs.open_output_stream(f"{root}/parts/{name}") as f:
                    pq.write_table(pa.Table.from_batches(held), f)
                parts.append({"name": name, "rows": sum(b.num_rows for b in held), "ranges": _ranges(held)})
                held.clear()

        try:
            for batch in iterator:
                if batch.num_rows:
                    held.append(batch)
                if sum(b.num_rows for b in held) >= PART_ROWS or sum(b.nbytes for b in held) >= PART_BYTES:
                    flush()
            flush()
        except BaseException:
            self._delete(parts)
            raise
        return Written(parts)

    def _delete(self, parts: list[dict]) -> None:
        fs, root = _open(self.path)
        for p in parts:
            fs.delete_file(f"{root}/parts/{p['name']}")

    def commit(self, messages: list) -> None:
        fs, root = _open(self.path)
        fs.create_dir(f"{root}/commits", recursive=True)
        body = {"replace": self.overwrite, "schema": self.schema.jsonValue(), "parts": [p for m in messages if m for p in m.parts]}
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        with fs.open_output_stream(f"{root}/commits/.{name}") as f:
            f.write(json.dumps(body).encode())
        fs.move(f"{root}/commits/.{name}", f"{root}/commits/{name}.json")

    def abort(self, messages: list) -> None:
        self._delete([p for m in messages if m for p in m.parts])


# ------------------------------------------------------------------- read ----
class Parts(D.InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


def _expression(f: D.Filter) -> pc.Expression | None:
    """The filter over Arrow columns, or None if it is not one of those that are pushed."""
    if isinstance(f, D.Not):
        inner = f.child
        if isinstance(inner, (D.EqualTo, D.In)):  # null stays null under not: such rows do not pass in either form
            found = _expression(inner)
            return None if found is None else ~found & pc.field(*inner.attribute).is_valid()
        return None
    column = pc.field(*f.attribute) if getattr(f, "attribute", None) else None
    if column is None:
        return None
    if isinstance(f, D.IsNotNull):
        return column.is_valid()
    if isinstance(f, D.IsNull):
        return column.is_null()
    value = getattr(f, "value", None)
    if isinstance(f, D.In):
        return column.isin(list(value)) if all(isinstance(v, (str, int, bool)) for v in value) else None
    if isinstance(value, bool) or not isinstance(value, (str, int)):
        return None
    compare = {D.EqualTo: column.__eq__, D.GreaterThan: column.__gt__, D.GreaterThanOrEqual: column.__ge__, D.LessThan: column.__lt__,
               D.LessThanOrEqual: column.__le__}.get(type(f))
    return compare(value) if compare else None


def _may_hold(f: D.Filter, ranges: dict) -> bool:
    """Whether a part with these value ranges can have rows that pass."""
    if len(getattr(f, "attribute", ())) != 1 or f.attribute[0] not in ranges or isinstance(f, (D.Not, D.IsNull)):
        return True
    low, high = ranges[f.attribute[0]]
    if low is None:  # nulls only
        return False
    v = getattr(f, "value", None)
    match f:
        case D.EqualTo():
            return low <= v <= high
        case D.In():
            return any(low <= x <= high for x in v if x is not None)
        case D.GreaterThan():
            return high > v
        case D.GreaterThanOrEqual():
            return high >= v
        case D.LessThan():
            return low < v
        case D.LessThanOrEqual():
            return low <= v
    return True


class CollectionReader(D.DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.schema, self.filters = path, schema, []

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:  # noqa: N802
        for f in filters:
            if _expression(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[Parts]:
        parts = [p for c in commits(self.path) for p in c["parts"] if all(_may_hold(f, p["ranges"]) for f in self.filters)]
        out, rows = [], PARTITION_ROWS
        for p in sorted(parts, key=lambda p: p["rows"]):
            if rows + p["rows"] > PARTITION_ROWS:
                out.append(Parts([]))
                rows = 0
            out[-1].names.append(p["name"])
            rows += p["rows"]
        return out or [Parts([])]

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        fs, root = _open(self.path)
        wanted = None
        for f in self.filters:
            e = _expression(f)
            wanted = e if wanted is None else wanted & e
        for name in partition.names:
            data = ds.dataset(f"{root}/parts/{name}", filesystem=fs, format="parquet")
            for batch in data.to_batches(filter=wanted):
                if batch.num_rows:
                    columns = [batch.column(f.name) if f.name in batch.schema.names else pa.nulls(batch.num_rows, to_arrow_type(f.dataType))
                               for f in self.schema.fields]
                    yield pa.RecordBatch.from_arrays(columns, names=self.schema.names)
