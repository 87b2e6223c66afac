"""Landed files as a stream: every file is processed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loadledger.contract import FILE_SCHEMA, SeriesContract
from loadledger.plans.refresh import incremental_refresh
from loadledger.session import pin_utc
from loadledger.sources.landing import (
    decode_payload,
    explode_records,
    landing_accept,
    to_history,
)


# The file source forgets names older than its newest file by this much and then
# takes files of that age for old. Backfills may be of any age, so it is a century.
OLDEST_FILE = "36500d"


def stream_records(
    spark: SparkSession,
    landing: str,
    contract: SeriesContract,
    files_per_batch: int = 10_000,
    oldest_file: str = OLDEST_FILE,
) -> DataFrame:
    """Streaming history rows from files that appear below ``landing``, whatever their age.

    A file that is overwritten in place is not seen again; landed files are
    immutable, and revisions come under names of their own.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", oldest_file)
        .load(landing)
    )
    decoded = decode_payload(landing_accept(files, contract))
    return to_history(explode_records(decoded), contract, totals=True)


def stream_bronze(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    contract: SeriesContract,
    require_complete: bool = True,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Start a query that takes all files present, then stops.

    Each micro-batch goes through the incremental refresh. A batch that is
    replayed after a failure adds nothing twice, because history holds a version
    once and older versions lose against newer ones.
    """
    pin_utc(spark)

    def refresh(batch: DataFrame, _batch_id: int) -> None:
        incremental_refresh(batch.sparkSession, batch, root, contract, require_complete)

    return (
        stream_records(spark, landing, contract, files_per_batch)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
