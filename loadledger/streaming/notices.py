"""Landed files as a stream of notices: what to read is told, not searched for.

A delivery appends one small file to a notice table, with a row for each file
that it landed. The stream's source is that table. What the source remembers is one
name per delivery, not one per landed file, and files of any age or order are
taken once they are announced, since only the notice's own time plays a part.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadledger.contract import SeriesContract
from loadledger.functions.paths import path_date
from loadledger.plans.landing import deliver_days
from loadledger.plans.refresh import incremental_refresh
from loadledger.session import pin_utc, scratch, stage_in
from loadledger.sources.landing import (
    decode_payload,
    explode_records,
    landing_accept,
    scan_days,
    to_history,
)

NOTICE = "path string, modified_at timestamp, date date"
# A stream that rests for longer than this might take old notices for seen ones.
OLDEST_NOTICE = "3650d"


def open_notices(spark: SparkSession, told: str) -> DataFrame:
    """The notice table, created if there is none."""
    spark.createDataFrame([], NOTICE).write.mode("ignore").parquet(told)
    return spark.read.schema(NOTICE).parquet(told)


def announce(spark: SparkSession, told: str, files: DataFrame) -> None:
    """Append the files (path, modificationTime) that the notice table lacks, as one file."""
    known = open_notices(spark, told).select("path")
    rows = files.select("path", F.col("modificationTime").alias("modified_at"), path_date("path").alias("date"))
    fresh = rows.join(known, "path", "left_anti")
    with scratch(spark, "notices") as folder:
        staged = stage_in(fresh, folder, "rows")
        if not staged.isEmpty():
            staged.coalesce(1).write.mode("append").parquet(told)


def deliver_and_announce(
    spark: SparkSession,
    records: DataFrame,
    landing: str,
    told: str,
    contract: SeriesContract,
    seen_at: datetime | None = None,
    complete: bool = True,
) -> DataFrame:
    """``deliver_days``, then a notice of what it landed.

    All files of the delivered days that no notice names are announced, so those
    of a delivery that died in between are told of by the next one.
    """
    judged = deliver_days(spark, records, landing, contract, seen_at=seen_at, complete=complete)
    announce(spark, told, landing_accept(scan_days(spark, landing, judged), contract).select("path", "modificationTime"))
    return judged


def stream_notices(
    spark: SparkSession,
    landing: str,
    told: str,
    root: str,
    checkpoint: str,
    contract: SeriesContract,
    require_complete: bool = True,
    notices_per_batch: int = 1000,
) -> StreamingQuery:
    """Start a query that takes all announced files, then stops.

    Each micro-batch lists the months of its files only and goes through the
    incremental refresh. A batch that is replayed after a failure adds nothing
    twice, because history holds a version once.
    """
    pin_utc(spark)
    open_notices(spark, told)

    def refresh(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        with scratch(session, "told") as folder:
            rows = stage_in(batch, folder, "rows")
            files = landing_accept(scan_days(session, landing, rows), contract)
            chosen = files.join(rows.select("path").distinct(), "path", "left_semi")
            records = to_history(explode_records(decode_payload(chosen)), contract, totals=True)
            incremental_refresh(session, records, root, contract, require_complete)

    return (
        spark.readStream.schema(NOTICE)
        .option("maxFilesPerTrigger", notices_per_batch)
        .option("maxFileAge", OLDEST_NOTICE)
        .parquet(told)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
