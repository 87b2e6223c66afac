"""Landed files packed into few large ones, which are read beside the originals.

A packed entry keeps the file's path, time, length, bytes and their hash, so
whatever is read from it is what the file itself would give. The zone stays
as it is: files that are not packed yet, or have changed since, are read from there.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.contract import FILE_SCHEMA, SeriesContract
from loadledger.functions.columns import content_fingerprint
from loadledger.functions.paths import path_date
from loadledger.sources.landing import landing_accept, scan_landing

ENTRY = "path string, modificationTime timestamp, length bigint, content binary, content_hash string, month string"


def packed_entries(
    spark: SparkSession, packed: str, dates: Sequence[date] | None = None
) -> DataFrame:
    """All entries, or those of the days from the first to the last of ``dates``."""
    spark.createDataFrame([], ENTRY).write.mode("ignore").partitionBy("month").parquet(packed)
    entries = spark.read.schema(ENTRY).parquet(packed)
    if not dates:
        return entries
    first, last = min(dates), max(dates)
    months = F.col("month").between(f"{first:%Y-%m}", f"{last:%Y-%m}")
    return entries.filter(months & path_date("path").between(F.lit(first), F.lit(last)))


LISTED = ("path", "modificationTime", "length")


def unpacked_files(files: DataFrame, entries: DataFrame) -> DataFrame:
    """Files of the zone that no entry holds with the same time and length.

    Names, times and lengths tell which; the first and last time of those then
    reach the scan, so files that were packed before them are not opened.
    """
    held = entries.select(*LISTED)
    due = files.select(*LISTED).join(held, list(LISTED), "left_anti")
    span = due.agg(F.min("modificationTime").alias("a"), F.max("modificationTime").alias("b")).first()
    if span["a"] is None:
        return files.limit(0)
    recent = files.filter(F.col("modificationTime").between(span["a"], span["b"]))
    return recent.join(held, list(LISTED), "left_anti")


def pack_zone(spark: SparkSession, zone: str, packed: str, contract: SeriesContract) -> None:
    """Add the accepted files that are not packed yet, a month's together.

    Rebalancing fills files up to the advisory size of a partition and splits a
    month that is larger, so their number goes with the bytes, not with the days.
    """
    files = landing_accept(scan_landing(spark, zone), contract)
    due = unpacked_files(files, packed_entries(spark, packed)).select(
        *FILE_SCHEMA.names,
        content_fingerprint("content").alias("content_hash"),
        F.date_format(path_date("path"), "yyyy-MM").alias("month"),
    )
    due.hint("rebalance", F.col("month")).write.mode("append").partitionBy("month").parquet(packed)


def scan_packed(
    spark: SparkSession, zone: str, packed: str, dates: Sequence[date] | None = None
) -> DataFrame:
    """The zone's files, as ``scan_landing`` gives them, opened only where no entry holds them.

    A file that was packed twice, with two times, counts with the one it has now. An
    entry whose bytes are not those it was packed with fails the job.
    """
    files = scan_landing(spark, zone, dates)
    entries = packed_entries(spark, packed, dates)
    sound = F.col("content_hash") == content_fingerprint("content")
    damaged = F.raise_error(F.concat(F.lit("packed entry differs from its hash: "), F.col("path")))
    content = F.when(sound, F.col("content")).otherwise(damaged.cast("binary"))
    # Which files are there, and with what times, only the zone can tell; no byte of them is read.
    held = entries.withColumn("content", content).join(files.select(*LISTED), list(LISTED), "left_semi")
    rest = unpacked_files(files, entries)
    return rest.select(*FILE_SCHEMA.names).unionByName(held.select(*FILE_SCHEMA.names))
