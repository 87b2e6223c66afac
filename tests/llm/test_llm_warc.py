from __future__ import annotations

import io
import struct
from pathlib import Path

import pyarrow as pa
import zstandard
from helpers import by_id
from pyspark.sql import functions as F

from loadledger.llm import warc
from loadledger.session import fresh_dir

PAGE = "page_id bigint, url string, html string, key string, n bigint, first_id string, bundle string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x", "x") for r in rows], PAGE)


def test_round_trip_and_revisits(spark):
    rows = [(5, "http://a/", "<p>é</p>"), (3, "http://b/\n x", "<p>é</p>"), (9, None, None), (4, "u", ""), (7, "u", "only")]
    found = by_id(warc.archived_pages(spark, pages(spark, rows)), "page_id")
    kinds = {p: (r["record_type"], r["refers_to"], r["payload_bytes"]) for p, r in found.items()}
    assert kinds == {3: ("response", None, 9), 5: ("revisit", 3, 9), 4: ("response", None, 0), 9: ("revisit", 4, 0), 7: ("response", None, 4)}
    assert found[4]["payload_digest"] == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_short_payloads_may_stand_alone(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]
    index = warc.write_archives(pages(spark, rows), fresh_dir(spark, "warc"), min_bytes=3)
    found = warc.read_archives(index).groupBy("record_type").count().collect()
    assert {r["record_type"]: r["count"] for r in found} == {"response": 3, "revisit": 1}


def test_repeated_and_null_ids(spark):
    rows = [(1, "u", "a"), (1, "u", "a"), (2, "u", "a"), (None, "u", "a"), (None, "u", "b")]
    found = warc.archived_pages(spark, pages(spark, rows)).collect()
    assert sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in found) == [
        (0, "response", 0), (0, "revisit", 1), (1, "response", 0), (1, "response", 0), (2, "revisit", 1)]


def test_empty_table(spark):
    root = fresh_dir(spark, "warc")
    index = warc.write_archives(pages(spark, []), root)
    assert index.collect() == [] and warc.read_archives(index).collect() == []
    assert list(Path(root.removeprefix("file://")).glob("*.zst")) == []


def test_frames_seek_table_and_lookup(spark):
    rows = [(n, f"http://h/{n}", f"<p>{n}</p>" * (n % 40 + 1)) for n in range(300)]
    index = warc.write_archives(pages(spark, rows), fresh_dir(spark, "warc"), frame_bytes=4000, bundle_bytes=6000)
    entries = index.collect()
    assert len({e["bundle"] for e in entries}) > 3 and max(e["frame"] for e in entries) > 1
    one = next(e for e in entries if e["record_id"] == warc.record_id(123))
    found = warc.lookup(index.filter(F.col("record_id") == warc.record_id(123))).collect()
    assert [bytes(r["payload"]).decode() for r in found] == [rows[123][2]]
    # any reader of the plain format sees the same records, and the table's sizes add up
    data = Path(one["bundle"].removeprefix("file://")).read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    records = list(warc.parse_records(plain))
    assert records[0][2]["WARC-Type"] == "warcinfo"
    frames = warc.read_seek_table(pa.BufferReader(data))
    assert len(frames) == struct.unpack("<I", data[-9:-5])[0]
    magic, size = struct.unpack_from("<II", data, frames[-1][0] + frames[-1][1])
    assert magic == warc.SKIPPABLE_MAGIC and frames[-1][0] + frames[-1][1] + 8 + size == len(data)


def test_damage_is_noticed(spark):
    index = warc.write_archives(pages(spark, [(1, "u", "hello")]), fresh_dir(spark, "warc"))
    path = Path(index.first()["bundle"].removeprefix("file://"))
    data = bytearray(path.read_bytes())
    other = warc._Bundles("", 1, 1, "t").squeeze.compress(
        warc.record_bytes("<urn:page:1>", "u", b"hello", None, "t").replace(b"\r\n\r\nhello", b"\r\n\r\nhellx"))
    frames = warc.read_seek_table(pa.BufferReader(bytes(data)))
    info = bytes(data[: frames[0][1]])
    path.write_bytes(info + other + warc.seek_table([(len(info), 1), (len(other), 1)]))
    try:
        warc.read_archives(index).collect()
    except Exception as error:
        assert "damaged payload" in str(error)
    else:
        raise AssertionError("damage went unnoticed")


def test_bundles_are_read_in_many_tasks(spark, tmp_path):
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "concat('page ', id) AS html").repartition(16)
    index = warc.write_archives(pages, str(tmp_path / "archives"))
    bundles = index.select("bundle").distinct().count()
    assert bundles >= 4
    found = warc.read_archives(index).groupBy(F.spark_partition_id()).count()
    assert found.count() >= 3  # of four tasks
