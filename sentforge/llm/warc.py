"""Seekable Zstandard bundles of WARC records.

A bundle is a file of independent Zstandard frames, each holding whole records,
followed by a skippable frame with the seek table (compressed and uncompressed
size of every frame) that readers of the seekable format find from the end.
An index row maps a record identifier to its bundle, frame and the record's
offset inside the frame's content, so one record costs one frame.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with
the largest id carries the payload (``response``); the others are ``revisit``
records that name it.  Writing tasks give every bundle a fresh name and report
it with their index rows; a lost or repeated task leaves a bundle that no index
row names, so the archive stays right.

Edge cases: a null payload is empty; repeated rows with the group's largest id
are all responses; a null id is the smallest, has an empty record id, and is
the response only where its whole group has null ids; a record larger than a
frame has a frame of its own; an empty table writes no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentforge.llm.common import new_folder, stage

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
_SKIPPABLE = 0x184D2A5E  # fixed values of the seekable format
_SEEKABLE = 0x8F92EAB1
INDEX = "id string, bundle string, frame int, offset bigint, length bigint"
RECORD = "id string, type string, payload_bytes bigint, payload_digest string, refers_to string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(rid: str, url: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC record; with ``refers_to`` a revisit without its payload."""
    kind, body = ("response", payload) if refers_to is None else ("revisit", b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{rid}>"]
    if url:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(content: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at an offset, and where the next begins."""
    end = content.index(b"\r\n\r\n", at)
    head = content[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(h.split(": ", 1) for h in head[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, content[start:stop], stop + 4


class BundleWriter:
    """Writes frames to a file and the seek table when closed."""

    def __init__(self, path: str, level: int = 3):
        where, name = fs.FileSystem.from_uri(path)
        self.out = where.open_output_stream(name, compression=None)
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.sizes: list[tuple[int, int]] = []
        self.written = 0

    def frame(self, content: bytes) -> None:
        packed = self.pack.compress(content)
        self.out.write(packed)
        self.sizes.append((len(packed), len(content)))
        self.written += len(packed)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, _SEEKABLE)
        self.out.write(struct.pack("<II", _SKIPPABLE, len(table)) + table)
        self.out.close()


class BundleReader:
    """Random access to the frames of a bundle through its seek table."""

    def __init__(self, path: str):
        where, name = fs.FileSystem.from_uri(path)
        self.file = where.open_input_file(name)
        size = self.file.size()
        self.file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != _SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        each = 12 if flags & 0x80 else 8
        self.file.seek(size - 9 - each * count)
        rows = self.file.read(each * count)
        self.frames, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", rows, each * i)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, number: int) -> bytes:
        at, packed, plain = self.frames[number]
        self.file.seek(at)
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str | None = "url", payload_col: str = "html",
                 min_revisit: int = 0) -> DataFrame:
    """``(id, url, payload, refers_to)``; ``refers_to`` is set for revisits only.

    Payloads are compared by SHA-256.  The join that tells the revisits is on
    small rows; payloads are then dealt by id, so no group of copies meets."""
    p = pages.select(F.col(id_col).alias("id"), *([F.col(url_col).alias("url")] if url_col else [F.lit(None).cast("string").alias("url")]),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    keys = stage(p.select("id", F.sha2("payload", 256).alias("key"), F.length("payload").alias("size")), "payloads")
    large = keys.filter(F.col("size") >= min_revisit)
    groups = stage(large.groupBy("key").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "first"), "groups")
    revisits = stage(large.join(groups, "key").filter(~F.col("id").eqNullSafe(F.col("first"))).select(
        F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("first").alias("refers_to")).distinct(), "revisits")
    joined = p.join(revisits, p.id.eqNullSafe(revisits["_id"]) & (F.sha2(p.payload, 256) == revisits["_key"]), "left")
    return joined.select("id", "url", "payload", "refers_to")


def write(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write bundles into ``folder``; returns the index (columns ``INDEX``)."""
    rows = records.select(F.col("id").cast("string").alias("id"), "url", "payload", F.col("refers_to").cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, path, index, entries, content, size = None, "", [], [], [], 0

        def flush():
            nonlocal writer, path, entries, content, size
            if not content:
                return
            if writer is None:
                path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
                writer = BundleWriter(path)
            index.extend((rid, path, len(writer.sizes), at, n) for rid, at, n in entries)
            writer.frame(b"".join(content))
            entries, content, size = [], [], 0
            if writer.written >= bundle_bytes:
                finish()

        def finish():
            nonlocal writer
            if writer is not None:
                writer.close()
                writer = None

        def ready():
            out = [list(c) for c in zip(*index, strict=True)]
            index.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                out, (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["id", "bundle", "frame", "offset", "length"])

        for b in batches:
            for rid, url, payload, refers in zip(*(c.to_pylist() for c in b.columns), strict=True):
                rec = record(rid or "", url, payload, refers)
                if content and size + len(rec) > frame_bytes:
                    flush()
                entries.append((rid, size, len(rec)))
                content.append(rec)
                size += len(rec)
            if writer is None and index:
                yield ready()
        flush()
        finish()
        if index:
            yield ready()

    return stage(rows.mapInArrow(run, INDEX), "index")  # a bundle is read only once its task has ended


def _columns(found: list[tuple]) -> pa.RecordBatch:
    cols = [list(c) for c in zip(*found, strict=True)] or [[]] * 6
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      names=["id", "type", "payload_bytes", "payload_digest", "refers_to", "payload"])


def _row(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    name = lambda key: (headers[key].removeprefix("<urn:page:").removesuffix(">") or None) if key in headers else None
    return (name("WARC-Record-ID"), headers["WARC-Type"], int(headers["X-Payload-Length"]),
            headers["WARC-Payload-Digest"].removeprefix("sha1:"), name("WARC-Refers-To"), block if with_payload else None)


def read(bundles: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the bundles named in column ``bundle`` (columns ``RECORD``), frame by frame."""
    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                reader = BundleReader(path)
                for k in range(len(reader.frames)):
                    content, at, found = reader.frame(k), 0, []
                    while at < len(content):
                        headers, block, at = parse(content, at)
                        if headers["WARC-Type"] == "response" and digest(block) != headers["WARC-Payload-Digest"].removeprefix("sha1:"):
                            raise ValueError(f"{path}: frame {k} is damaged")
                        found.append(_row(headers, block, with_payload))
                    yield _columns(found)
                reader.close()

    names = bundles.select("bundle").distinct()
    return names.mapInArrow(run, RECORD)


def fetch(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows; only the frames they lie in are read."""
    def run(batches):
        reader, at, content = None, None, b""
        for b in batches:
            found = []
            for path, frame, offset in zip(b.column("bundle").to_pylist(), b.column("frame").to_pylist(), b.column("offset").to_pylist(), strict=True):
                if at is None or at[0] != path:
                    reader, at = BundleReader(path), (path, None)
                if at[1] != frame:
                    content, at = reader.frame(frame), (path, frame)
                headers, block, _ = parse(content, offset)
                found.append(_row(headers, block, with_payload))
            yield _columns(found)

    return index.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "offset").select(
        "bundle", "frame", "offset").mapInArrow(run, RECORD)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write all pages into bundles below ``folder`` (default: a new one in the shared folder) and return the index."""
    folder = folder or new_folder(spark, "warc")
    if "://" not in folder:
        folder = ("file://" if folder.startswith("/") else "file:///") + folder if not folder.startswith("file:") else "file://" + folder.removeprefix("file:")
    where, name = fs.FileSystem.from_uri(folder)
    where.create_dir(name, recursive=True)
    return write(plan_records(pages, **columns), folder)
