"""Web archives as seekable Zstandard bundles.

Each task writes its records to bundle files: records are grouped into independent Zstandard frames,
and a seek table in a skippable frame at the end of the file lists the frames (the public seekable
format). The index leads from a record's row id to its frame and to the record's place inside the
unpacked frame, so one record costs one frame. Files have fresh names and only those that a finished
task reports are ever read, so a task that is run again leaves nothing wrong behind.

Defined results: null payload is an empty one; a row without an id is written and read like others;
rows that repeat both id and payload are records with one identifier. Other columns are not archived.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trueledger.llm.common import Batches, stored
from trueledger.session import work_dir

#: Fixed values of the public seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
#: Fixed text of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
INDEX = "row_id long, path string, frame int, frame_offset long, frame_size long, record_offset long, record_size long"


def with_roles(df: DataFrame, row_id: str, url: str, payload: str, least_bytes: int = 100) -> DataFrame:
    """``row_id, url, payload, digest, payload_bytes, refers_to``: which rows only point at an earlier payload.

    Of rows with equal payloads of at least ``least_bytes`` those with the smallest id hold it and the
    others refer to that id.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(row_id).cast("long").alias("row_id"), F.col(url).alias("url"), body.alias("payload")).withColumns(
        {"digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    firsts = (
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("row_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    held = F.col("first_id").isNull() | F.col("row_id").eqNullSafe(F.col("first_id"))
    return rows.join(stored(firsts, "warc-firsts"), "digest", "left").select(
        "row_id", "url", "payload", "digest", "payload_bytes", F.when(~held, F.col("first_id")).alias("refers_to")
    )


def _identifier(row_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{row_id}:{digest}')}>"


def record(row_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit holds the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_identifier(row_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if row_id is not None:
        lines.append(f"X-Row-Id: {row_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_identifier(refers_to, digest)}", f"X-Refers-To-Row: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Bundle:
    """A bundle file being written."""

    def __init__(self, store: pafs.FileSystem, folder: str, uri: str):
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.path, self.out = f"{uri}/{name}", store.open_output_stream(f"{folder}/{name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.written, self.rows, self.raw, self.held = 0, [], [], 0
        self.index: list[tuple] = []

    def add(self, row_id: int | None, data: bytes) -> None:
        self.rows.append((row_id, self.held, len(data)))
        self.raw.append(data)
        self.held += len(data)
        if self.held >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if not self.raw:
            return
        packed = zstandard.ZstdCompressor(level=6, write_checksum=True).compress(b"".join(self.raw))
        self.out.write(packed)
        self.index += [(row_id, self.path, len(self.frames), self.written, len(packed), at, size) for row_id, at, size in self.rows]
        self.frames.append((len(packed), self.held))
        self.written += len(packed)
        self.rows, self.raw, self.held = [], [], 0

    def close(self) -> list[tuple]:
        self.close_frame()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        return self.index


def write(rows: DataFrame, folder: str | None = None, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Archives ``rows`` (as made by ``with_roles``) below ``folder`` and returns the stored index."""
    uri = folder or work_dir(rows.sparkSession, "warc")
    schema = pa.schema(
        [("row_id", pa.int64()), ("path", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("frame_size", pa.int64()), ("record_offset", pa.int64()), ("record_size", pa.int64())]
    )

    def run(batches: Batches) -> Batches:
        store, path = pafs.FileSystem.from_uri(uri)
        store.create_dir(path, recursive=True)
        bundle = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                bundle = bundle or _Bundle(store, path, uri)
                bundle.add(row[0], record(*row, date))
                if bundle.written >= BUNDLE_BYTES:
                    yield _batch(bundle.close(), schema)
                    bundle = None
        if bundle:
            yield _batch(bundle.close(), schema)

    narrow = rows.select("row_id", "url", "payload", "digest", "refers_to")
    return stored(narrow.mapInArrow(run, INDEX), "warc-index")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _open(path: str) -> pa.NativeFile:
    store, name = pafs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def seek_table(file: pa.NativeFile) -> list[tuple[int, int]]:
    """Offset and size of each frame, from the footer."""
    size = file.size()
    n, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    entries = file.read_at(8 * n, size - 9 - 8 * n)
    sizes = [struct.unpack_from("<II", entries, 8 * i)[0] for i in range(n)]
    starts = [0]
    for s in sizes:
        starts.append(starts[-1] + s)
    return list(zip(starts, sizes, strict=False))


def parse(frame: bytes, at: int = 0, end: int | None = None) -> Iterator[dict]:
    """The records of an unpacked frame; a payload that does not have its digest raises."""
    end = len(frame) if end is None else end
    while at < end:
        head_end = frame.index(b"\r\n\r\n", at)
        headers = dict(line.split(": ", 1) for line in frame[at:head_end].decode().split("\r\n")[1:])
        body = frame[head_end + 4 : head_end + 4 + int(headers["Content-Length"])]
        at = head_end + 4 + len(body) + 4
        http_end = body.index(b"\r\n\r\n")
        payload, digest = body[http_end + 4 :], headers["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = headers["WARC-Type"]
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", body[: http_end + 4])[1])
        number = lambda name: int(headers[name]) if name in headers else None
        yield {
            "row_id": number("X-Row-Id"),
            "url": headers.get("WARC-Target-URI"),
            "record_type": kind,
            "digest": digest,
            "payload_bytes": length,
            "refers_to": number("X-Refers-To-Row"),
            "payload": payload if kind == "response" else None,
        }


RECORDS = "row_id long, url string, record_type string, digest string, payload_bytes long, refers_to long, payload binary"
_RECORD_TYPES = pa.schema(
    [("row_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def frames(paths: DataFrame) -> DataFrame:
    """``path, frame_offset, frame_size`` of every frame of the bundles in column ``path``."""

    def run(batches: Batches) -> Batches:
        schema = pa.schema([("path", pa.string()), ("frame_offset", pa.int64()), ("frame_size", pa.int64())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with _open(path) as file:
                    yield _batch([(path, at, size) for at, size in seek_table(file)], schema)

    return paths.select("path").mapInArrow(run, "path string, frame_offset long, frame_size long")


def read_frames(found: DataFrame) -> DataFrame:
    """Every record of the given frames."""

    def run(batches: Batches) -> Batches:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for path, at, size in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                with _open(path) as file:
                    yield pa.RecordBatch.from_pylist(list(parse(unpack.decompress(file.read_at(size, at)))), _RECORD_TYPES)

    return found.select("path", "frame_offset", "frame_size").mapInArrow(run, RECORDS)


def fetch(index: DataFrame) -> DataFrame:
    """The records of the given index rows, each read from its own frame."""

    def run(batches: Batches) -> Batches:
        unpack, last, frame = zstandard.ZstdDecompressor(), None, b""
        for batch in batches:
            found = []
            for path, at, size, start, length in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if (path, at) != last:
                    with _open(path) as file:
                        frame, last = unpack.decompress(file.read_at(size, at)), (path, at)
                found += parse(frame, start, start + length)
            yield pa.RecordBatch.from_pylist(found, _RECORD_TYPES)

    return index.select("path", "frame_offset", "frame_size", "record_offset", "record_size").mapInArrow(run, RECORDS)


def read(spark: SparkSession, index: DataFrame) -> DataFrame:
    """All records of the archives that ``index`` names, found by the archives' own seek tables."""
    paths = index.select("path").distinct()
    tasks = spark.sparkContext.defaultParallelism * 2
    return read_frames(frames(paths).repartition(tasks, "path", "frame_offset"))
