"""Delivering days to the landing zone as new files or as revisions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.contract import CANONICAL, DAY_KEY, SeriesContract
from loadledger.operators.days import NEW, UNCHANGED, classify_days, day_fingerprint
from loadledger.operators.quality import QualityError, checkpoint_rules, enforce, quality_report
from loadledger.operators.state import day_checkpoint, next_checkpoint, processing_range
from loadledger.session import scratch, stage, stage_in
from loadledger.sources.checkpoints import read_checkpoint, write_checkpoint
from loadledger.sources.landing import (
    check_days,
    land_days,
    landed_versions,
    landed_versions_of,
    landing_accept,
    scan_days,
)


def deliver_days(
    spark: SparkSession,
    records: DataFrame,
    root: str,
    contract: SeriesContract,
    baseline: str = CANONICAL,
    seen_at: datetime | None = None,
    complete: bool = True,
) -> DataFrame:
    """Land the delivered days and return their classification.

    New days become canonical files, changed days revisions named after their
    content, unchanged days are not written. With ``baseline="latest"`` a day
    that returns to earlier values counts as changed again; ``seen_at`` (UTC) then
    keeps its revision name apart from the earlier one, and goes into the payload.

    Days that are not fit, landed files that cannot be read and other content
    under a landed name are errors, and nothing is written then.
    """
    if baseline != CANONICAL and seen_at is None:
        raise ValueError("comparing with the latest version needs seen_at")
    with scratch(spark, "delivery") as folder:
        delivered = stage_in(records, folder, "records")
        # Before anything is collected per day.
        check_days(delivered, contract, complete)
        # Only the months of the delivered days are listed, only their files read, once.
        found = landed_versions_of(spark, root, delivered, contract)
        landed = stage_in(found, folder, "landed")
        judged = stage(
            classify_days(day_fingerprint(delivered), landed, baseline), "classified"
        )
        suffix = "" if baseline == CANONICAL else f"_at_{seen_at:%Y%m%dT%H%M%S}"
        version = F.when(F.col("status") == NEW, F.lit(CANONICAL)).otherwise(
            F.concat(F.lit("revision_"), F.col("revision_id"), F.lit(suffix))
        )
        named = judged.filter(F.col("status") != UNCHANGED).select(
            *DAY_KEY, version.alias("version")
        )
        # A repeated delivery finds its versions and writes nothing.
        due = delivered.join(named, list(DAY_KEY))
        land_days(due, root, contract, complete, seen_at, landed, checked=True)
    return judged


def due_days(records: DataFrame, state: DataFrame, contract: SeriesContract, end: str) -> DataFrame:
    """(respondent, date) of the days to process, from the stored state and the delivery.

    Respondents fold on the map side; each then has one row per due day.
    """
    known = records.groupBy("respondent").agg(F.max("date").alias("last"))
    ranges = processing_range(known.join(state, "respondent", "left"), contract, F.lit(end))
    days = F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day")))
    return ranges.filter("has_work").select("respondent", days.alias("date"))


def ingest_days(
    spark: SparkSession,
    records: DataFrame,
    root: str,
    checkpoint: str,
    contract: SeriesContract,
    end_date: str,
    complete: bool = True,
) -> DataFrame:
    """Deliver the days that are due up to ``end_date``, then advance the checkpoint.

    Each respondent starts before its last delivered day, so that late changes
    of the days in the lookback are seen, or at the first date of the contract.
    The checkpoint moves over days that the zone is seen to hold; a run that
    fails leaves it, and the next one delivers the same days again.
    """
    state = read_checkpoint(spark, checkpoint, contract)
    enforce(quality_report(state, checkpoint_rules()))
    with scratch(spark, "ingest") as folder:
        wanted = due_days(records, state, contract, end_date)
        due = stage_in(records.join(wanted, ["respondent", "date"], "left_semi"), folder, "due")
        due = due.select(*records.columns)
        judged = deliver_days(spark, due, root, contract, complete=complete)
        files = landing_accept(scan_days(spark, root, judged), contract)
        stored = landed_versions(files).select(*DAY_KEY).distinct()
        lost = judged.join(stored, list(DAY_KEY), "left_anti").select(*DAY_KEY).limit(1).collect()
        if lost:
            raise QualityError(f"day not found after landing: {lost[0][0]} {lost[0][1]}")
        write_checkpoint(next_checkpoint(state, day_checkpoint(judged)), checkpoint)
    return judged
