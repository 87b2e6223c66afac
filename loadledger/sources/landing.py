"""Landed payload files: writing them, and reading them back as records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from loadledger.contract import (
    CANONICAL,
    DAY_KEY,
    FILE_SCHEMA,
    PAYLOAD_SCHEMA,
    READING_KEY,
    RECORD_FIELDS,
    SeriesContract,
)
from loadledger.functions.columns import content_fingerprint, safe_numeric
from loadledger.functions.paths import (
    is_landing_path,
    path_date,
    path_respondent,
    path_version,
    source_of,
)
from loadledger.operators.days import CONFLICT, WRITE, day_fingerprint, day_records, landing_conflicts
from loadledger.operators.quality import QualityError, Rule, audit_days, enforce, quality_report
from loadledger.session import scratch, stage_in


# A payload's records as they are, whatever fields they hold.
WHOLE_RECORDS = "response STRUCT<data: ARRAY<VARIANT>>"


def open_zone(spark: SparkSession, root: str) -> None:
    """Create an empty landing zone if there is none; without rows no file is written."""
    nothing = spark.createDataFrame([], "value string, respondent string")
    nothing.write.mode("ignore").partitionBy("respondent").text(root)


def scan_landing(
    spark: SparkSession, root: str, dates: Sequence[date] | None = None
) -> DataFrame:
    """Files below ``root`` with path, modification time, length and bytes.

    With dates only the months from the first to the last of them are listed,
    whatever the layout below, and only files between the two come back. The
    bytes are read only where a later step uses them.
    """
    if dates is None:
        return _zone_files(spark).load(root)
    if not dates:
        return spark.createDataFrame([], FILE_SCHEMA)
    first, last = min(dates), max(dates)
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return _scan_months(spark, root, months).filter(path_date("path").between(F.lit(first), F.lit(last)))


def scan_days(spark: SparkSession, root: str, days: DataFrame) -> DataFrame:
    """Files of the days whose ``date`` is in ``days``.

    Only the months that these lie in are listed, so one late revision of an old
    day does not list all that came since. The calendar bounds how many months there can be.
    """
    dates = days.select("date").filter("date IS NOT NULL").distinct()
    months = dates.select(F.expr("year(date) * 12 + month(date) - 1").alias("n")).distinct()
    listed = sorted(r["n"] for r in months.collect())
    if not listed:
        return spark.createDataFrame([], FILE_SCHEMA)
    files = _scan_months(spark, root, listed).withColumn("_date", path_date("path"))
    return files.join(dates, files["_date"] == dates["date"], "left_semi").drop("_date")


def _zone_files(spark: SparkSession) -> DataFrameReader:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true")


def _scan_months(spark: SparkSession, root: str, months: Sequence[int]) -> DataFrame:
    """Files of the given months, counted from year 0, whatever the layout below."""
    folders = ",".join(f"year={n // 12:04d}/month={n % 12 + 1:02d}" for n in months)
    try:
        return _zone_files(spark).load(f"{root}/respondent=*/{{{folders}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILE_SCHEMA)  # nothing has landed in these months


def between(start: date, end: date) -> list[date]:
    """The dates from start to end."""
    return [start + timedelta(days=n) for n in range((end - start).days + 1)]


def landing_accept(files: DataFrame, contract: SeriesContract) -> DataFrame:
    """Daily files and their revisions; anything else in the zone is left out."""
    return files.filter(is_landing_path("path", contract))


def accepted_counts(files: DataFrame, contract: SeriesContract) -> DataFrame:
    """How many files of the zone are daily files or revisions, and how many are neither."""
    accepted = is_landing_path("path", contract)
    return files.agg(
        F.count_if(accepted).alias("accepted"), F.count_if(~accepted).alias("rejected")
    )


def decode_payload(files: DataFrame) -> DataFrame:
    """Files with their payload as a struct and the fingerprint of their bytes.

    A file that is no valid payload gets null parts, not an error. ``records`` are
    the whole records, with fields that the payload's schema does not name; they
    are parsed only where a later step uses them.
    """
    text = F.col("content").cast("string")
    payload = F.from_json(text, PAYLOAD_SCHEMA)
    return files.select(
        source_of("path").alias("source_path"),
        F.col("modificationTime").alias("source_modified_at"),
        content_fingerprint("content").alias("content_hash"),
        payload.alias("payload"),
        F.from_json(text, WHOLE_RECORDS)["response"]["data"].alias("records"),
    ).select(
        "*",
        path_respondent(F.concat("source_path", F.lit("/"))).alias("path_respondent"),
        path_date(F.concat("source_path", F.lit("/"))).alias("path_date"),
        path_version("source_path").alias("version"),
    )


def _totals() -> tuple[Column, Column]:
    """Declared and actual number of records of a payload."""
    actual = F.coalesce(F.size("payload.response.data"), F.lit(0))
    return F.col("payload.response.total").try_cast("int"), actual


def declared_totals(decoded: DataFrame) -> DataFrame:
    """Declared and actual number of records of every file."""
    declared, actual = _totals()
    return decoded.select(
        "source_path",
        F.col("path_respondent").alias("respondent"),
        F.col("path_date").alias("date"),
        "version",
        declared.alias("declared_total"),
        actual.alias("record_count"),
        F.coalesce(declared == actual, F.lit(False)).alias("total_matches"),
    )


def explode_records(decoded: DataFrame, whole: bool = False) -> DataFrame:
    """One row per record, all declared fields as text.

    A file without records gives one row of nulls, so that the required-field
    rule sees it. ``whole`` adds ``record``, the record with all its fields.
    """
    seen_at = F.try_to_timestamp(F.col("payload.ingestion_metadata.downloaded_at_utc"))
    declared, actual = _totals()
    rows = decoded.select(
        "source_path",
        "source_modified_at",
        "content_hash",
        "path_respondent",
        "path_date",
        "version",
        seen_at.alias("observed_at"),
        declared.alias("declared_total"),
        actual.alias("record_count"),
        *(("records",) if whole else ()),
        F.posexplode_outer("payload.response.data").alias("_at", "_declared"),
    )
    fields = [F.col(f"_declared.`{name}`").alias(name) for name in RECORD_FIELDS]
    if whole:
        fields.append(F.get("records", "_at").alias("record"))
    kept = [c for c in rows.columns if c not in ("_at", "_declared", "records")]
    return rows.select(*kept, *fields)


def to_history(
    exploded: DataFrame, contract: SeriesContract, totals: bool = False
) -> DataFrame:
    """Exploded records in the shape of the history table.

    Versions are ordered as the contract says. ``totals`` keeps the declared and
    the actual number of records of each row's file, for the gate.
    """
    if contract.by_observation:
        seen = F.coalesce("observed_at", "source_modified_at")
        exploded = exploded.withColumn("source_modified_at", seen)
    return exploded.select(
        "period",
        "respondent",
        "type",
        safe_numeric("value").alias("value"),
        F.col("`value-units`").alias("value_units"),
        "source_path",
        "source_modified_at",
        "content_hash",
        *(("declared_total", "record_count") if totals else ()),
    )


def read_records(spark: SparkSession, root: str, contract: SeriesContract) -> DataFrame:
    """All accepted files below ``root`` as history rows."""
    files = landing_accept(scan_landing(spark, root), contract)
    return to_history(explode_records(decode_payload(files)), contract)


def check_landed(decoded: DataFrame) -> None:
    """Refuse a zone with files that hold no readable records, repeat a key, or belong elsewhere.

    A file that cannot be read must not make its day count as new.
    """
    rules = [
        Rule("landed files readable", "period IS NULL OR type IS NULL"),
        Rule("records in their folder", "respondent <> path_respondent"),
    ]
    rows = explode_records(decoded)
    report = quality_report(rows, rules, ("source_path", *READING_KEY), "landed keys unique")
    unreadable = rows.filter("period IS NULL").select("source_path")
    enforce(report, {"landed files readable": unreadable.distinct()})


def landed_days(decoded: DataFrame) -> DataFrame:
    """Fingerprint of every landed version of a day, with what orders the versions.

    ``check_landed`` says beforehand whether all files can be read; of one that
    cannot, no row comes out.
    """
    rows = explode_records(decoded, whole=True).filter("period IS NOT NULL")
    rows = rows.withColumn("date", F.col("path_date"))
    return day_fingerprint(rows, extra=("version", "source_modified_at", "source_path"))


def payload_text(
    records: DataFrame, extra: tuple[str, ...] = (), seen_at: datetime | None = None
) -> DataFrame:
    """One JSON payload per day: sorted whole records, their number as text, the download time."""
    days = day_records(records, extra)
    total = F.col("record_count").cast("string")
    head = '{"response":{"data":'
    if seen_at is not None:
        head = f'{{"ingestion_metadata":{{"downloaded_at_utc":"{seen_at.isoformat()}"}},{head[1:]}'
    text = F.concat(F.lit(head), "records_json", F.lit(',"total":"'), total, F.lit('"}}'))
    return days.select(*DAY_KEY, *extra, text.alias("payload"))


def check_days(records: DataFrame, contract: SeriesContract, complete: bool) -> None:
    """Refuse days with repeated or foreign keys; with ``complete``, also gaps and nulls."""
    audit = audit_days(records, contract)
    flaws = F.col("duplicate_keys") + F.col("unexpected_keys")
    if complete:
        flaws = flaws + F.col("missing_keys") + F.col("null_values")
    bad = audit.filter(flaws > 0).agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first"))
    found = bad.first()
    if found["n"]:
        raise QualityError(f"{found['n']} days are not fit for landing, from {found['first']}")


def land_days(
    records: DataFrame,
    root: str,
    contract: SeriesContract,
    complete: bool = True,
    seen_at: datetime | None = None,
    landed: DataFrame | None = None,
    checked: bool = False,
) -> None:
    """Write one file per day and version below ``root``.

    ``records`` carries the record fields, the declared ``date`` and, unless
    every day is canonical, its ``version``. Each day is one row by the time it
    is written, so every version folder gets exactly one part file and no
    repartitioning is needed. A version that is already there is not written
    again; other content under a known version is an error, and nothing is
    written then. ``landed`` gives the versions of these days, if the caller
    knows them; ``checked`` says that the caller found the days fit and holds the
    records in files.
    """
    spark = records.sparkSession
    if "version" not in records.columns:
        records = records.withColumn("version", F.lit(CANONICAL))
    if not checked:
        check_days(records, contract, complete)
    with scratch(spark, "landing") as folder:
        if not checked:
            records = stage_in(records, folder, "records")
        if landed is None:
            landed = landed_versions_of(spark, root, records, contract)
        keys = [*DAY_KEY, "version"]
        named = day_fingerprint(records, extra=("version",))
        outcomes = stage_in(landing_conflicts(named, landed), folder, "outcomes")
        clash = outcomes.filter(F.col("outcome") == CONFLICT).select(*keys)
        rule = Rule("landed versions unchanged", f"outcome = '{CONFLICT}'")
        enforce(quality_report(outcomes, [rule]), {rule.name: clash})
        due = outcomes.filter(F.col("outcome") == WRITE).select(*keys)
        rows = payload_text(records.join(due, keys, "left_semi"), ("version",), seen_at).select(
            F.col("payload").alias("value"),
            "respondent",
            F.date_format("date", "yyyy").alias("year"),
            F.date_format("date", "MM").alias("month"),
            F.date_format("date", "dd").alias("day"),
            "version",
        )
        layout = ["respondent", "year", "month", "day", "version"]
        rows.write.mode("append").partitionBy(*layout).text(root)


def landed_versions_of(
    spark: SparkSession, root: str, records: DataFrame, contract: SeriesContract
) -> DataFrame:
    """Fingerprints of what the zone holds of the days of ``records``."""
    open_zone(spark, root)
    decoded = decode_payload(landing_accept(scan_days(spark, root, records), contract))
    check_landed(decoded)
    return landed_days(decoded)


def landed_versions(files: DataFrame) -> DataFrame:
    """(date, respondent, version) of accepted files, from their paths alone."""
    return files.select(
        path_date("path").alias("date"),
        path_respondent("path").alias("respondent"),
        path_version("path").alias("version"),
    )
