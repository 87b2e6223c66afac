"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each with a group of whole
records, and ends in a seek table: a skippable frame that lists the compressed
and plain size of every frame. The index maps a record identifier to its bundle,
frame and offset within the plain frame, so one record costs one seek and one
small frame. Bundles are plain files in the shared folder; a task that is
repeated writes new ones, and only the index of the attempt that Spark commits
names any.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.llm.tables import shuffle_partitions, stage
from loadledger.session import fresh_dir

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 256 << 10  # plain bytes after which a frame ends
BUNDLE_BYTES = 64 << 20  # compressed bytes after which a bundle ends
CAPTURED_AT = "2024-01-01T00:00:00Z"  # the pages carry no time of their own
INDEX = "record_id string, bundle string, frame int, frame_start long, frame_bytes long, offset long, length long"
RECORD = "record_id string, record_type string, refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_id_of(identifier: Column) -> Column:
    return F.regexp_extract(identifier, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(
    identifier: str, url: str | None, payload: bytes, refers_to: str | None, captured_at: str
) -> bytes:
    """One record; a revisit keeps the HTTP head, whose length is that of the payload left out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {identifier}",
        f"WARC-Date: {captured_at}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:  # a header is one line
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(plain: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records in a plain frame."""
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        lines = plain[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at offset {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        yield at, stop + 4 - at, headers, plain[start:stop]
        at = stop + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame at the end of a bundle, from (compressed, plain) sizes."""
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    body = entries + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int]]:
    """(start, compressed size) of the frames of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    count, descriptor, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    entry = 12 if descriptor & 0x80 else 8
    file.seek(size - 9 - count * entry)
    table = file.read(count * entry)
    frames, start = [], 0
    for n in range(count):
        packed, _ = struct.unpack_from("<II", table, n * entry)
        frames.append((start, packed))
        start += packed
    return frames


class _Bundles:
    """Writes the records of one task; gives index rows."""

    def __init__(self, root: str, frame_bytes: int, bundle_bytes: int, captured_at: str) -> None:
        self.root, self.captured_at = root, captured_at
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.squeeze = zstandard.ZstdCompressor(level=3)
        self.file: pa.NativeFile | None = None
        self.rows: list[tuple] = []
        self.held: list[tuple[str, bytes]] = []
        self.held_bytes = 0

    def add(self, identifier: str, record: bytes) -> None:
        self.held.append((identifier, record))
        self.held_bytes += len(record)
        if self.held_bytes >= self.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.held:
            return
        if self.file is None:
            self.path = f"{self.root}/{uuid.uuid4().hex}.warc.zst"
            system, place = _open(self.path)
            self.file, self.sizes, self.start = system.open_output_stream(place, compression=None), [], 0
            info = "software: loadledger\r\nformat: WARC File Format 1.1\r\n"
            head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\n"
            head += f"WARC-Date: {self.captured_at}\r\nContent-Type: application/warc-fields\r\n"
            self._frame(f"{head}Content-Length: {len(info)}\r\n\r\n{info}\r\n\r\n".encode())
        number, start = len(self.sizes), self.start
        size = self._frame(b"".join(record for _, record in self.held))
        offset = 0
        for identifier, record in self.held:
            self.rows.append((identifier, self.path, number, start, size, offset, len(record)))
            offset += len(record)
        self.held, self.held_bytes = [], 0
        if self.start >= self.bundle_bytes:
            self.end_bundle()

    def _frame(self, plain: bytes) -> int:
        packed = self.squeeze.compress(plain)
        self.file.write(packed)
        self.sizes.append((len(packed), len(plain)))
        self.start += len(packed)
        return len(packed)

    def end_bundle(self) -> None:
        self.end_frame()
        if self.file is not None:
            self.file.write(seek_table(self.sizes))
            self.file.close()
            self.file = None


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, first_id): the smallest page_id with an equal payload.

    Payloads below ``min_bytes`` stand alone. Null page_ids never come first
    unless a payload has no other.
    """
    own = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keyed = own.withColumn("key", F.sha2(F.col("html").cast("binary"), 256))
    groups = keyed.filter(F.octet_length("html") >= min_bytes).groupBy("key")
    firsts = groups.agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    # Only payloads that occur again need the join's other side.
    again = firsts.filter("n > 1").select("key", "first_id")
    joined = keyed.join(again, "key", "left")
    return joined.select("page_id", "url", "html", F.coalesce("first_id", "page_id").alias("first_id"))


def write_archives(
    pages: DataFrame,
    root: str,
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    captured_at: str = CAPTURED_AT,
) -> DataFrame:
    """Write a record per row of ``pages`` below ``root``; returns the index.

    Of rows with equal html (null counts as empty) the one with the smallest
    page_id is a response, the others are revisits that refer to it; if that
    row itself is repeated, each copy is a response. A null page_id has the
    identifier ``<urn:page:>``. Html of any length is one record, in a frame of its own where it is
    longer than a frame. Other columns are not read. An empty table gives
    an empty index and no file.
    """
    spark = pages.sparkSession

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Bundles(root, frame_bytes, bundle_bytes, captured_at)
        names = [c.split()[0] for c in INDEX.split(", ")]

        def index() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*out.rows)] if out.rows else [[] for _ in names]
            kinds = ["string", "string", "int32", "int64", "int64", "int64", "int64"]
            out.rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for part in parts:
            for page_id, url, html, first in zip(*(c.to_pylist() for c in part.columns)):
                refers_to = None if first == page_id else record_id(first)
                own = record_id(page_id)
                out.add(own, record_bytes(own, url, html.encode(), refers_to, captured_at))
            if len(out.rows) > 10_000:
                yield index()
        out.end_bundle()
        yield index()

    system, place = _open(root)
    system.create_dir(place, recursive=True)
    return stage(with_originals(pages, min_bytes).mapInArrow(write, INDEX), "warc-index")


def _record(headers: dict[str, str], block: bytes) -> tuple:
    head, payload = block.split(b"\r\n\r\n", 1)
    length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
    named = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != length or digest(payload) != named):
        raise ValueError(f"damaged payload in {headers['WARC-Record-ID']}")
    return (
        headers["WARC-Record-ID"], kind, headers.get("WARC-Refers-To"), headers.get("WARC-Target-URI"),
        named, length, payload if kind == "response" else None,
    )


_KINDS = ["string", "string", "string", "string", "string", "int64", "binary"]


def _batches(records: Iterator[tuple], payloads: bool) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RECORD.split(", ")]
    rows: list[tuple] = []
    size = 0
    for row in chain(records, [None]):
        if row is not None:
            rows.append(row if payloads else (*row[:-1], None))
            size += len(row[-1] or b"") if payloads else 64
        if rows and (row is None or size > 4 << 20):
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names)
            rows, size = [], 0


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles that an index names, checked against their digests.

    Frames are found by each bundle's own seek table and read one at a time.
    """

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            expand = zstandard.ZstdDecompressor()
            for part in parts:
                for path in part.column(0).to_pylist():
                    system, place = _open(path)
                    with system.open_input_file(place) as file:
                        for start, size in read_seek_table(file):
                            file.seek(start)
                            plain = expand.decompress(file.read(size))
                            for _, _, headers, block in parse_records(plain):
                                if headers["WARC-Type"] != "warcinfo":
                                    yield _record(headers, block)

        return _batches(records(), payloads)

    # A few names, but much to read behind each. They are dealt out by another hash than that of
    # ``distinct``, into a fixed number of tasks, which adaptive execution leaves as they are.
    bundles = index.select("bundle").distinct()
    dealt = bundles.repartition(shuffle_partitions(index.sparkSession), F.xxhash64("bundle"))
    return dealt.mapInArrow(read, RECORD)


def lookup(index: DataFrame) -> DataFrame:
    """The records of the given index rows, each by one seek and one frame."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            expand = zstandard.ZstdDecompressor()
            for part in parts:
                for path, start, size, offset, length in zip(*(c.to_pylist() for c in part.columns)):
                    system, place = _open(path)
                    with system.open_input_file(place) as file:
                        file.seek(start)
                        plain = expand.decompress(file.read(size))
                    for _, _, headers, block in parse_records(plain[offset : offset + length]):
                        yield _record(headers, block)

        return _batches(records(), True)

    places = index.select("bundle", "frame_start", "frame_bytes", "offset", "length")
    return places.mapInArrow(read, RECORD)


def archived_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to a new folder and describe what the archives hold."""
    index = write_archives(pages, fresh_dir(spark, "warc"))
    found = read_archives(index, payloads=False)
    return found.select(
        page_id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id_of(F.col("refers_to")).alias("refers_to"),
    )
