"""Taking a batch of records through all layers, touching only changed dates."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.contract import (
    DAY_KEY,
    HISTORY_SCHEMA,
    HOUR_KEY,
    READING_KEY,
    VERSION_KEY,
    SeriesContract,
)
from loadledger.functions.columns import period_sql
from loadledger.functions.paths import path_date, source_of
from loadledger.operators.daily import daily_kpi
from loadledger.operators.hourly import paired_hours, pivot_hourly
from loadledger.operators.merge import (
    INSERTED,
    KEPT,
    UNCHANGED,
    UPDATED,
    merge_daily,
    merge_hourly,
)
from loadledger.operators.quality import (
    Rule,
    Watch,
    daily_rules,
    duplicate_keys,
    enforce,
    enforce_findings,
    hourly_rules,
    incomplete_days,
    latest_rules,
    not_empty_report,
    quality_report,
    record_rules,
    unpaired_hours,
)
from loadledger.operators.versions import latest_per_key, merge_latest
from loadledger.session import pin_utc, remove, scratch, stage_in
from loadledger.sources import tables
from loadledger.sources.landing import (
    accepted_counts,
    between,
    decode_payload,
    explode_records,
    landing_accept,
    scan_landing,
    to_history,
)
from loadledger.sources.tables import LAYERS, days_of, on_dates_of, read_layer, with_date

STATS = "layer string, action string, row_count bigint"
ACTIONS = (INSERTED, UPDATED, UNCHANGED, KEPT)
# What a decoded batch may carry beside the history columns.
TOTALS = ("declared_total", "record_count")


def _changed(merged: DataFrame) -> DataFrame:
    return merged.filter(F.col("action").isin(INSERTED, UPDATED))


def gate_records(records: DataFrame, contract: SeriesContract) -> DataFrame:
    """The rules a batch must pass before anything is stored."""
    rules = [
        *record_rules(contract),
        Rule("period parses", f"period IS NOT NULL AND {period_sql()} IS NULL"),
    ]
    if set(TOTALS) <= set(records.columns):
        rules.append(Rule("declared total", "NOT coalesce(declared_total = record_count, false)"))
    return quality_report(
        records,
        rules,
        unique=("source_path", *READING_KEY),
        unique_name="key unique within its file",
    )


def known_versions(batch: DataFrame, history: DataFrame) -> DataFrame:
    """The batch with ``fresh``: whether history lacks the version.

    A version that history holds keeps the time that history gives it, whatever
    its file says now, so that latest stays what history makes it.
    """
    known = history.select(*VERSION_KEY, F.col("source_modified_at").alias("_known_at"))
    paired = batch.join(known, list(VERSION_KEY), "left")
    return paired.withColumns(
        {
            "fresh": F.col("_known_at").isNull(),
            "source_modified_at": F.coalesce("_known_at", "source_modified_at"),
        }
    ).drop("_known_at")


def incremental_refresh(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    contract: SeriesContract,
    require_complete: bool = True,
) -> DataFrame:
    """Bring a batch of history rows into all layers below ``root``.

    Returns the merge outcomes as rows (layer, action, row_count).

    The batch decides which dates, hours and days are looked at; every other
    partition is neither read nor written. Each layer's new dates are written
    to folders of this run and pass their gates before one commit makes all of
    them count. A run that dies before it leaves the tables as they were.

    ``require_complete`` stops the run on hours without both measure types and
    on days with a wrong number of hours. What the run supersedes stays on disk
    until ``tables.clean_up``, so results that are held stay readable.
    """
    pin_utc(spark)
    run = uuid.uuid4().hex
    published = False
    with scratch(spark, "batch") as folder:
        try:
            stats, entries = _refresh(spark, batch, root, contract, require_complete, run, folder)
            if entries is not None:
                tables.commit(spark, root, entries)
            published = True
        finally:
            if not published:
                for layer in LAYERS:
                    remove(spark, tables.run_path(root, layer, run))
    return spark.createDataFrame(stats, STATS)


def _refresh(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    contract: SeriesContract,
    require_complete: bool,
    run: str,
    folder: str,
) -> tuple[list[tuple[str, str, int]], DataFrame | None]:
    """Outcomes, and the (layer, date, run) rows to commit; none for an empty batch."""
    own = [*HISTORY_SCHEMA.names, *[n for n in TOTALS if n in batch.columns]]
    incoming = stage_in(with_date(batch.select(*own)), folder, "incoming")
    enforce(gate_records(incoming, contract))
    days = days_of(incoming)
    if not days:
        return [], None

    def stored(layer: str, changed: DataFrame) -> DataFrame:
        rows = on_dates_of(read_layer(spark, root, layer, days), changed)
        return rows.select(*LAYERS[layer].names)

    resolved = stage_in(known_versions(incoming, stored("history", incoming)), folder, "resolved")
    stats: list[tuple[str, str, int]] = []

    def written(
        rows: DataFrame, layer: str, watch: Watch, culprits: Callable[[DataFrame], dict[str, DataFrame]]
    ) -> DataFrame:
        """Write a layer's dates; the gate and the outcomes come out of the same pass."""
        found = tables.write_run(rows, root, layer, run, watch, ACTIONS)
        enforce_findings(watch.findings(), culprits(found))
        stats.extend((layer, action, n) for action, n in watch.tally().items() if n)
        return found

    newest = latest_per_key(resolved.select(*HISTORY_SCHEMA.names))
    latest = written(
        with_date(merge_latest(stored("latest", incoming), newest)),
        "latest",
        Watch(latest_rules(contract), READING_KEY, "latest unique", 1, "action"),
        lambda rows: {"latest unique": duplicate_keys(rows, READING_KEY)},
    )
    touched = _changed(latest)

    readings = on_dates_of(latest, touched).join(
        touched.select(*HOUR_KEY).distinct(), list(HOUR_KEY), "left_semi"
    )
    hourly = written(
        merge_hourly(stored("hourly", touched), pivot_hourly(readings, contract)),
        "hourly",
        Watch(hourly_rules() if require_complete else [], HOUR_KEY, "hourly unique", 11, "action"),
        lambda rows: {
            "actual and forecast paired": unpaired_hours(rows),
            "hourly unique": duplicate_keys(rows, HOUR_KEY),
        },
    )
    changed_days = _changed(hourly).select(*DAY_KEY).distinct()
    whole = paired_hours(hourly.join(changed_days, list(DAY_KEY), "left_semi"))
    daily = written(
        merge_daily(stored("daily", touched), daily_kpi(whole)),
        "daily",
        Watch(daily_rules(contract) if require_complete else [], DAY_KEY, "daily unique", 21, "action"),
        lambda rows: {
            "complete days": incomplete_days(rows, contract),
            "daily unique": duplicate_keys(rows, DAY_KEY),
        },
    )
    appended = Watch()
    fresh = tables.write_run(
        resolved.filter("fresh").select(*HISTORY_SCHEMA.names, "date"), root, "history", run, appended
    )
    if appended.rows():
        stats.append(("history", INSERTED, appended.rows()))

    entries = fresh.select(F.lit("history").alias("layer"), "date")
    for layer, rows in {"latest": latest, "hourly": hourly, "daily": daily}.items():
        entries = entries.unionByName(_changed(rows).select(F.lit(layer).alias("layer"), "date"))
    return stats, entries.distinct().withColumn("run", F.lit(run))


def new_files(files: DataFrame, history: DataFrame, contract: SeriesContract) -> DataFrame:
    """(source_path, modificationTime, date) of files that history does not hold yet.

    Names and times tell; no file is opened. A file whose time moved is looked
    at again. Where versions are ordered by observation, history knows no file
    times, and the name alone decides.
    """
    listed = files.select(
        source_of("path").alias("source_path"),
        "modificationTime",
        path_date("path").alias("date"),
    )
    keys = ["source_path"] if contract.by_observation else ["source_path", "modificationTime"]
    known = history.withColumnRenamed("source_modified_at", "modificationTime")
    return listed.join(known.select(*keys).distinct(), keys, "left_anti")


def run_pipeline(
    spark: SparkSession,
    landing: str,
    root: str,
    contract: SeriesContract,
    dates: Sequence[date] | None = None,
    require_complete: bool = True,
) -> DataFrame:
    """Landed files to history, latest, hourly and daily tables, in that order.

    Any failing gate raises and leaves the tables as they were. With dates only
    the folders of their months are listed, and only files of those days count.
    Files that history holds already are not opened. Beside the merge outcomes
    the result counts the files accepted, rejected and read.
    """
    pin_utc(spark)
    scanned = scan_landing(spark, landing, dates)
    counts = accepted_counts(scanned, contract).first()
    files = landing_accept(scanned, contract)
    enforce(not_empty_report(files.select("path"), "accepted files present"))
    with scratch(spark, "files") as folder:
        span = between(min(dates), max(dates)) if dates else None
        history = read_layer(spark, root, "history", span)
        due = stage_in(new_files(files, history, contract), folder, "due")
        span = due.agg(
            F.count(F.lit(1)).alias("n"),
            F.min("modificationTime").alias("first"),
            F.max("modificationTime").alias("last"),
        ).first()
        outcome = [
            ("files", "accepted", counts["accepted"]),
            ("files", "rejected", counts["rejected"]),
            ("files", "read", span["n"]),
        ]
        stats = spark.createDataFrame(outcome, STATS)
        if span["n"]:
            # The times reach the scan, so older files are not opened.
            recent = files.filter(F.col("modificationTime").between(span["first"], span["last"]))
            recent = recent.withColumn("source_path", source_of("path"))
            chosen = recent.join(due.select("source_path").distinct(), "source_path", "left_semi")
            records = to_history(explode_records(decode_payload(chosen)), contract, totals=True)
            merged = incremental_refresh(spark, records, root, contract, require_complete)
            stats = stats.unionByName(merged)
    return stats
