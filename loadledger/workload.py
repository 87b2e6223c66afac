"""The registered queries: every operator over the driver's tables.

The tables hold no series, so ``events`` is read as one: each event publishes a
reading for its hour, and later events of the hour revise it. Feeds (event
types) belong to one of two respondents, and a number in the event's properties
tells actual from forecast readings.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.contract import HOURLY_SCHEMA, PERIOD_FORMAT, READING_KEY, SeriesContract
from loadledger.functions import columns as fc
from loadledger.functions import paths as fp
from loadledger.operators import (
    compare,
    coverage,
    daily,
    days,
    hourly,
    merge,
    quality,
    state,
    trailing,
    validity,
    versions,
)
from loadledger.plans.landing import deliver_days, ingest_days as deliver_due
from loadledger.plans.rebuild import daily_from_history, hourly_from_history
from loadledger.plans.refresh import incremental_refresh, run_pipeline
from loadledger.plans.snapshots import diff_snapshots, summarize_snapshots, write_snapshot
from loadledger.plans.trailing import refresh_trailing, start_trailing
from loadledger.session import fresh_dir, pin_utc
from loadledger.sources import landing, packed, snapshots, tables
from loadledger.streaming import latest, notices
from loadledger.streaming.bronze import stream_bronze

Query = Callable[[SparkSession, str], DataFrame]

CONTRACT = SeriesContract(
    respondents=("OPS", "WEB"), file_prefix="feed", initial_date="2024-01-01"
)
# What the raw feed is checked against: one feed and one measure type are foreign to it.
STRICT = SeriesContract(
    respondents=("click", "purchase", "signup", "view"),
    file_prefix="feed",
    initial_date="2024-01-01",
    forecast_type="F",
)
OBSERVED = replace(CONTRACT, by_observation=True)
WEB_FEEDS = ("click", "signup", "view")
FIRST_FEEDS = ("click", "purchase", "view")
SECOND_FEEDS = ("error", "purchase", "signup")
CHANGES_FROM = "2024-01-06"
NEWS_FROM = "2024-01-26"
FEED = "substring_index(source_path, '/', 1)"

_ZONES: dict[tuple[str, str, str], str] = {}


# ---------------------------------------------------------------- the series


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


# What was published first: all of the early days, some feeds of the middle ones.
FIRST = (
    f"ts < TIMESTAMP_NTZ '{CHANGES_FROM}' OR "
    f"(ts < TIMESTAMP_NTZ '{NEWS_FROM}' AND event_type IN ({fc.sql_list(FIRST_FEEDS)}))"
)
# What followed. One feed of the middle days comes again; both together hold all events.
SECOND = (
    f"ts >= TIMESTAMP_NTZ '{CHANGES_FROM}' AND "
    f"(ts >= TIMESTAMP_NTZ '{NEWS_FROM}' OR event_type IN ({fc.sql_list(SECOND_FEEDS)}))"
)


def readings(spark: SparkSession, sf_dir: str, delivery: str = "true") -> DataFrame:
    """Events of a delivery, or all, as history rows."""
    return events(spark, sf_dir).filter(delivery).selectExpr(
        f"date_format(ts, {fc.sql_text(PERIOD_FORMAT)}) AS period",
        f"CASE WHEN event_type IN ({fc.sql_list(WEB_FEEDS)}) THEN 'WEB' ELSE 'OPS' END AS respondent",
        "get_json_object(props, '$.k') AS level",
        "CASE WHEN CAST(level AS INT) < 50 THEN 'D' ELSE 'DF' END AS type",
        "CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value",
        "'megawatthours' AS value_units",
        "concat(event_type, '/', lpad(event_id, 12, '0')) AS source_path",
        "CAST(ts AS TIMESTAMP) AS source_modified_at",
        "sha2(concat(event_id, '|', props), 256) AS content_hash",
    )


def history(spark: SparkSession, sf_dir: str, delivery: str = "true") -> DataFrame:
    return readings(spark, sf_dir, delivery).drop("level")


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records that are not clean: daily files, foreign units, text for numbers."""
    return events(spark, sf_dir).selectExpr(
        "event_id",
        "concat(event_type, '/', date_format(ts, 'yyyy-MM-dd')) AS source_path",
        f"date_format(ts, {fc.sql_text(PERIOD_FORMAT)}) AS period",
        "event_type AS respondent",
        "CASE WHEN CAST(get_json_object(props, '$.k') AS INT) < 50 THEN 'D' ELSE 'DF' END AS type",
        "CASE WHEN event_type = 'click' THEN props "
        "ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END AS value_raw",
        "CASE WHEN event_type = 'signup' THEN 'signups' ELSE 'megawatthours' END AS value_units",
    ).withColumn("value", fc.safe_numeric("value_raw"))


def to_records(
    latest: DataFrame, value: str = "CAST(CAST(value AS DECIMAL(18,2)) AS STRING)"
) -> DataFrame:
    """Served readings as raw records with their declared day."""
    return latest.selectExpr(
        "period",
        "respondent",
        "lower(respondent) AS `respondent-name`",
        "type",
        f"{FEED} AS `type-name`",
        f"{value} AS value",
        "value_units AS `value-units`",
        f"to_date({fc.period_sql()}) AS date",
    )


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(versions.latest_per_key(history(spark, sf_dir)))


def first_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_records(versions.latest_per_key(history(spark, sf_dir, FIRST)))


def _zone(spark: SparkSession, sf_dir: str, deliveries: str) -> str:
    """A landing zone after the first or after both deliveries, made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, deliveries)
    if key not in _ZONES:
        root = fresh_dir(spark, "zone")
        deliver_days(spark, first_delivered(spark, sf_dir), root, CONTRACT, complete=False)
        if deliveries == "both":
            deliver_days(spark, delivered(spark, sf_dir), root, CONTRACT, complete=False)
        _ZONES[key] = root
    return _ZONES[key]


def _files(spark: SparkSession, sf_dir: str, deliveries: str = "both") -> DataFrame:
    files = landing.scan_landing(spark, _zone(pin_utc(spark), sf_dir, deliveries))
    return landing.landing_accept(files, CONTRACT)


def _decoded(spark: SparkSession, sf_dir: str, deliveries: str = "both") -> DataFrame:
    return landing.decode_payload(_files(spark, sf_dir, deliveries))


# ---------------------------------------------------------------- versions


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.latest_per_key(history(spark, sf_dir))


def revision_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.revision_stats(history(spark, sf_dir))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(spark, sf_dir)
    return versions.layer_counts(rows, versions.latest_per_key(rows))


def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = history(spark, sf_dir, FIRST), history(spark, sf_dir, SECOND)
    return versions.history_append(first, second)


def new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = history(spark, sf_dir, FIRST), history(spark, sf_dir, SECOND)
    return versions.new_versions(first, second)


def merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = versions.latest_per_key(history(spark, sf_dir, FIRST))
    arriving = versions.latest_per_key(history(spark, sf_dir, SECOND))
    return versions.merge_latest(stored, arriving)


def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_stats(merge_latest(spark, sf_dir))


def validity_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = validity.validity_intervals(history(spark, sf_dir))
    return found.select(*READING_KEY, "source_path", "valid_from", "valid_to")


def as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event asks for the reading of its hour as it was served ten minutes and half a day later."""
    later = F.explode(F.array(F.expr("interval 10 minutes"), F.expr("interval 12 hours")))
    asked = history(spark, sf_dir).select(*READING_KEY, "source_path", "source_modified_at", later.alias("later"))
    pairs = asked.select(
        *READING_KEY,
        F.col("source_path").alias("asked_by"),
        (F.col("source_modified_at") + F.col("later")).alias("as_of"),
    )
    found = validity.as_of(history(spark, sf_dir), pairs)
    return found.select(*READING_KEY, "asked_by", "as_of", "value", "source_path", "source_modified_at")


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = versions.latest_per_key(history(spark, sf_dir))
    found = versions.key_lookup(served, period="2024-01-15T12", respondent="WEB")
    return found.select("period", "type", "value", "source_modified_at", "source_path")


def preview_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = versions.latest_per_key(history(spark, sf_dir))
    return served.orderBy("period", "type", "respondent").limit(20)


# ---------------------------------------------------------------- layers


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_from_history(history(spark, sf_dir), CONTRACT)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_from_history(history(spark, sf_dir), CONTRACT)


def _first_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_from_history(history(spark, sf_dir, FIRST), CONTRACT)


def _first_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_from_history(history(spark, sf_dir, FIRST), CONTRACT)


def pivot_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly.pivot_hourly(versions.latest_per_key(history(spark, sf_dir)), CONTRACT)


def forecast_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = hourly.paired_hours(_hourly(spark, sf_dir))
    return paired.select("period", "respondent", "forecast_error_mwh", "absolute_error_mwh")


def merge_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = hourly_from_history(history(spark, sf_dir, SECOND), CONTRACT)
    return merge.merge_hourly(_first_hourly(spark, sf_dir), second)


def daily_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.with_completeness(_daily(spark, sf_dir), CONTRACT)


def merge_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = daily_from_history(history(spark, sf_dir, SECOND), CONTRACT)
    return merge.merge_daily(_first_daily(spark, sf_dir), second)


def latest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.latest_dates(_daily(spark, sf_dir), 10)


def trailing_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.trailing_kpi(_hourly(spark, sf_dir), CONTRACT)


def trailing_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of the first delivery, brought up to date with what the second changes."""
    path = fresh_dir(pin_utc(spark), "trailing")
    first, every = _first_hourly(spark, sf_dir), _hourly(spark, sf_dir)
    start_trailing(first, f"{path}/0")
    return trailing.served_windows(refresh_trailing(spark, first, every, f"{path}/0", f"{path}/1"), CONTRACT)


def weekend_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.weekend_share(_daily(spark, sf_dir))


# ---------------------------------------------------------------- quality


def dq_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(raw_feed(spark, sf_dir), quality.record_rules(STRICT))


def _twice_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An hourly layer that a faulty writer would leave: two deliveries one after the other."""
    return _first_hourly(spark, sf_dir).unionByName(_hourly(spark, sf_dir))


def _twice_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_daily(spark, sf_dir).unionByName(_daily(spark, sf_dir))


def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers that hold what they should not: all versions, and two deliveries, side by side."""
    file_key = ("source_path", *READING_KEY)
    in_file = quality.quality_report(
        raw_feed(spark, sf_dir), [], file_key, "key unique within its file", 1
    )
    latest = quality.quality_report(
        history(spark, sf_dir), [], READING_KEY, "latest unique", 2
    )
    per_hour = quality.quality_report(
        _twice_hourly(spark, sf_dir), [], ("period", "respondent"), "hourly unique", 3
    )
    per_day = quality.quality_report(
        _twice_daily(spark, sf_dir), [], ("date", "respondent"), "daily unique", 4
    )
    return in_file.unionByName(latest).unionByName(per_hour).unionByName(per_day)


def dq_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unpaired_hours(_hourly(spark, sf_dir))


def dq_hourly_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        _twice_hourly(spark, sf_dir), quality.hourly_rules(), ("period", "respondent")
    )


def dq_daily_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        _twice_daily(spark, sf_dir), quality.daily_rules(CONTRACT), ("date", "respondent")
    )


def gated_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers that hold what they should not, judged as they are written."""
    root = fresh_dir(pin_utc(spark), "layers")
    hours, day_rules = quality.hourly_rules(), quality.daily_rules(CONTRACT)
    layers = {
        "latest": (
            tables.with_date(history(spark, sf_dir)),
            quality.Watch(quality.latest_rules(CONTRACT), READING_KEY, "latest unique", 1),
        ),
        "hourly": (
            _twice_hourly(spark, sf_dir),
            quality.Watch(hours, ("period", "respondent"), "hourly unique", 11),
        ),
        "daily": (
            _twice_daily(spark, sf_dir),
            quality.Watch(day_rules, ("date", "respondent"), "daily unique", 21),
        ),
    }
    found = []
    for layer, (rows, watch) in layers.items():
        tables.write_run(rows, root, layer, "watched", watch)
        found += [*watch.findings(), (watch.first + 9, f"{layer} rows", watch.rows())]
    return spark.createDataFrame(found, "ordinal int, check string, violations long")


def dq_complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.incomplete_days(_daily(spark, sf_dir), CONTRACT)


def dq_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed, in which one feed is filed under the day after."""
    late = F.when(F.col("respondent") == "signup", 1).otherwise(0)
    dated = raw_feed(spark, sf_dir).withColumn("date", F.date_add(fc.period_date("period"), late))
    return quality.audit_days(dated, STRICT)


def dq_declared_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of the first delivery, of which some declare one record more than they hold."""
    days_ = landing.payload_text(first_delivered(spark, sf_dir))
    wrong = (F.col("respondent") == "WEB") & (F.dayofmonth("date") % 2 == 0)
    total = F.regexp_extract("payload", r'"total":"(\d+)"', 1)
    more = F.concat(F.lit('"total":"'), (total.cast("int") + 1).cast("string"), F.lit('"'))
    text = F.when(wrong, F.regexp_replace("payload", F.lit(r'"total":"\d+"'), more))
    files = days_.select(
        F.concat(
            F.lit("/zone/"),
            fp.landing_folder("respondent", "date"),
            F.lit("/"),
            fp.canonical_name("date", CONTRACT),
        ).alias("path"),
        F.lit("2024-02-01").cast("timestamp").alias("modificationTime"),
        F.coalesce(text, "payload").cast("binary").alias("content"),
    )
    return landing.declared_totals(landing.decode_payload(files)).drop("source_path")


def dq_accepted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of a zone, and one in which only unfinished and misnamed files have arrived."""
    files = candidate_paths(spark, sf_dir)
    unfit = files.filter(F.col("kind").isin("short id", "upper case id", "unfinished", "hour range"))
    all_, none = (landing.landing_accept(f, CONTRACT) for f in (files, unfit))
    first = quality.not_empty_report(all_, "accepted files present", 0)
    return first.unionByName(quality.not_empty_report(none, "accepted files among the unfit", 1))


def accepted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.accepted_counts(candidate_paths(spark, sf_dir), CONTRACT)


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(raw_feed(spark, sf_dir), ("source_path", *READING_KEY))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expected_grid(_expected_days(spark, sf_dir), CONTRACT)


def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage_gaps(history(spark, sf_dir), _grid(spark, sf_dir))


def _expected_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("source_modified_at")
    bounds = (
        history(spark, sf_dir)
        .groupBy("respondent")
        .agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))
    )
    return quality.date_range(bounds)


def coverage_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_bitmap(history(spark, sf_dir), _expected_days(spark, sf_dir), CONTRACT)


def day_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.day_masks(history(spark, sf_dir), CONTRACT)


def gap_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that the first delivery left open."""
    return coverage.gap_runs(history(spark, sf_dir, FIRST), _expected_days(spark, sf_dir), CONTRACT)


# ---------------------------------------------------------------- landing


def candidate_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of several kinds, good and bad, for every day of the series."""
    found = (
        history(spark, sf_dir)
        .select("respondent", F.to_date("source_modified_at").alias("date"))
        .distinct()
    )
    folder = F.concat(F.lit("/zone/"), fp.landing_folder("respondent", "date"), F.lit("/"))
    name = fp.canonical_name("date", CONTRACT)
    digest = F.sha2(F.concat("respondent", F.col("date").cast("string")), 256)
    revision = fp.revision_name(name, digest)
    version = F.concat(F.lit("version=revision_"), digest, F.lit("/part-00000-a.c000.txt"))
    kinds = {
        "canonical": name,
        "revision": F.concat(F.lit("revisions/"), revision),
        "sha256": F.concat(
            F.lit("revisions/"), F.replace(revision, F.lit("_revision_"), F.lit("_sha256_"))
        ),
        "short id": fp.revision_name(name, F.substring(digest, 1, 63)),
        "upper case id": fp.revision_name(name, F.upper(digest)),
        "unfinished": F.concat(name, F.lit(".tmp")),
        "hour range": F.replace(name, F.lit(".json"), F.lit("T00_to_T23.json")),
        "version folder": version,
    }
    pairs = [F.struct(F.lit(k).alias("kind"), F.concat(folder, n).alias("path")) for k, n in kinds.items()]
    return found.select(F.inline(F.array(*pairs)))


def landing_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = landing.landing_accept(candidate_paths(spark, sf_dir), CONTRACT)
    return accepted.select("kind", "path")


def parse_landing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_paths(spark, sf_dir).select(
        "path",
        fp.path_respondent("path").alias("respondent"),
        fp.path_date("path").alias("date"),
        fp.path_version("path").alias("version"),
        fp.path_revision_id("path").alias("revision_id"),
        fp.source_of("path").alias("source_path"),
    )


def _last_day(spark: SparkSession, sf_dir: str) -> date:
    return events(spark, sf_dir).agg(F.to_date(F.max("ts"))).first()[0]


def scan_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days from the first revision on, read with folder pruning."""
    root = _zone(pin_utc(spark), sf_dir, "both")
    dates = landing.between(date.fromisoformat(CHANGES_FROM), _last_day(spark, sf_dir))
    files = landing.scan_landing(spark, root, dates)
    return landing.landed_versions(landing.landing_accept(files, CONTRACT))


def land_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries into a new zone; the outcome of the second."""
    root = fresh_dir(pin_utc(spark), "zone")
    deliver_days(spark, first_delivered(spark, sf_dir), root, CONTRACT, complete=False)
    return deliver_days(spark, delivered(spark, sf_dir), root, CONTRACT, complete=False)


def ingest_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with a stored checkpoint; the second looks one day back."""
    root, saved = fresh_dir(pin_utc(spark), "zone"), fresh_dir(spark, "checkpoint")
    for records, end in (
        (first_delivered(spark, sf_dir), "2024-01-25"),
        (delivered(spark, sf_dir), str(_last_day(spark, sf_dir))),
    ):
        outcome = deliver_due(spark, records, root, saved, CONTRACT, end, complete=False)
    return outcome


def decode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select(
        F.col("path_respondent").alias("respondent"),
        F.col("path_date").alias("date"),
        "version",
        F.size("payload.response.data").alias("record_count"),
        F.col("payload.response.total").alias("total"),
    )


def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir).select(
        F.col("path_respondent").alias("respondent"),
        F.col("path_date").alias("date"),
        "version",
        "content_hash",
    )


def explode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record_rows(landing.explode_records(_decoded(spark, sf_dir)))


def _record_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "version",
        "period",
        "respondent",
        F.col("`respondent-name`").alias("respondent_name"),
        "type",
        F.col("`type-name`").alias("type_name"),
        F.col("value").alias("value_raw"),
        F.col("`value-units`").alias("value_units"),
    )


def safe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_feed(spark, sf_dir).select("event_id", "value_raw", "value")


def parse_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours written in three ways, of which only one is the agreed format."""
    spellings = F.array(
        F.date_format("ts", PERIOD_FORMAT),
        F.date_format("ts", "yyyy-MM-dd HH"),
        F.date_format("ts", "yyyy/MM/dd'T'HH"),
    )
    texts = events(spark, sf_dir).select(F.explode(spellings).alias("period")).distinct()
    return texts.select(
        "period",
        fc.parse_period("period").alias("period_ts"),
        fc.period_date("period").alias("date"),
    )


def day_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.day_fingerprint(delivered(spark, sf_dir))


def record_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records twice, of which some have another eighth field the second time."""
    root = fresh_dir(pin_utc(spark), "zone")
    edition = F.expr("CASE WHEN respondent = 'WEB' AND day(date) % 2 = 0 THEN 2 ELSE 1 END")
    for number in (F.lit(1), edition):
        origin = F.struct(F.col("value-units").alias("unit"), number.alias("edition"))
        records = delivered(spark, sf_dir).withColumn("origin", origin)
        outcome = deliver_days(spark, records, root, CONTRACT, complete=False)
    return outcome


def classify_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landing.landed_days(_decoded(spark, sf_dir, "first"))
    return days.classify_days(days.day_fingerprint(delivered(spark, sf_dir)), landed)


def landing_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landing.landed_days(_decoded(spark, sf_dir, "first"))
    due = days.day_fingerprint(delivered(spark, sf_dir)).withColumn("version", F.lit("canonical"))
    return days.landing_conflicts(due, landed)


# ---------------------------------------------------------------- compare


def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery against the first, with whole-number values."""
    mine = to_records(versions.latest_per_key(readings(spark, sf_dir, SECOND)), "level")
    theirs = to_records(versions.latest_per_key(readings(spark, sf_dir, FIRST)), "level")
    return compare.snapshot_diff(mine, theirs)


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _diff(spark, sf_dir).drop("changed_fields")


def changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = _diff(spark, sf_dir).filter(F.size("changed_fields") > 0)
    return changed.select(*READING_KEY, F.array_join("changed_fields", ",").alias("changed_fields"))


def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.diff_summary(_diff(spark, sf_dir))


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """All records, and those of the first delivery, as stored snapshots with digests."""
    path = fresh_dir(pin_utc(spark), "snapshots")
    write_snapshot(delivered(spark, sf_dir), f"{path}/mine")
    write_snapshot(first_delivered(spark, sf_dir), f"{path}/theirs")
    return f"{path}/mine", f"{path}/theirs"


def snapshot_digest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff_snapshots(spark, *_snapshots(spark, sf_dir)).drop("changed_fields")


def digest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize_snapshots(spark, *_snapshots(spark, sf_dir))


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full series against what could be published after the first delivery."""
    mine = hourly.paired_hours(_hourly(spark, sf_dir))
    published = hourly.paired_hours(_first_hourly(spark, sf_dir))
    return compare.reconcile(
        mine, published, daily.daily_kpi(mine), daily.daily_kpi(published), CONTRACT
    )


def reconcile_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours and days behind ``reconcile``; the published hours carry other column names."""
    mine = hourly.paired_hours(_hourly(spark, sf_dir))
    published = hourly.paired_hours(_first_hourly(spark, sf_dir))
    renamed = published.withColumnsRenamed({"actual_demand_mwh": "actual", "forecast_demand_mwh": "forecast"})
    names = {"actual_demand_mwh": ["demand", "actual"], "forecast_demand_mwh": ["forecast"]}
    aligned = compare.with_alternatives(renamed, names)
    return compare.reconcile_failures(
        mine, aligned, daily.daily_kpi(mine), daily.daily_kpi(published)
    )


def first_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events give their level, others their value; no table has the first column."""
    feeds = events(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_type") == "click", F.get_json_object("props", "$.k")).otherwise(F.lit("")).alias("level"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        "event_type",
    )
    number = fc.first_present(feeds, ["actual_demand_mwh", "level", "value"], numeric=True)
    text = fc.first_present(feeds, ["time", "level", "event_type"])
    return feeds.select("event_id", number.alias("first_number"), text.alias("first_text"))


def normalize_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All spellings of an hour come to one key."""
    spellings = F.array(
        F.date_format("ts", PERIOD_FORMAT),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
    )
    texts = events(spark, sf_dir).select("event_id", F.explode(spellings).alias("text"))
    return texts.select(
        "event_id",
        "text",
        fc.normalize_hour("text").alias("hour_key"),
        fc.normalize_date("text").alias("date_key"),
    )


def read_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(pin_utc(spark), "snapshot")
    snapshots.export_snapshot(_hourly(spark, sf_dir), path)
    return snapshots.read_snapshot(spark, path, HOURLY_SCHEMA)


# ---------------------------------------------------------------- state and runs


def processing_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    reached = state.day_checkpoint(_first_daily(spark, sf_dir))
    return state.processing_range(reached, CONTRACT, F.lit("2024-01-30"))


def processing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    reached = state.batch_checkpoint(history(spark, sf_dir, FIRST))
    return state.processing_hours(reached, CONTRACT)


def next_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous = state.batch_checkpoint(history(spark, sf_dir, FIRST))
    reached = state.batch_checkpoint(history(spark, sf_dir, SECOND))
    return state.next_checkpoint(previous, reached)


def checkpoint_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last hour, judged as if it were a stored checkpoint."""
    last = events(spark, sf_dir).groupBy("user_id").agg(
        F.date_format(F.max("ts"), PERIOD_FORMAT).alias("last_uploaded_hour")
    )
    return quality.quality_report(last, quality.checkpoint_rules())


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    root = fresh_dir(pin_utc(spark), "layers")
    first, second = history(spark, sf_dir, FIRST), history(spark, sf_dir, SECOND)
    incremental_refresh(spark, first, root, CONTRACT, require_complete=False)
    outcome = incremental_refresh(spark, second, root, CONTRACT, require_complete=False)
    return root, outcome


def incremental_refresh_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _refreshed(spark, sf_dir)
    return tables.published(spark, root, "daily")


def refresh_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir)[1]


def _served(spark: SparkSession, root: str) -> DataFrame:
    return tables.published(spark, root, "latest").select(
        *READING_KEY,
        "value",
        "value_units",
        fp.path_version("source_path").alias("version"),
        "content_hash",
    )


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = _zone(pin_utc(spark), sf_dir, "both")
    root = fresh_dir(spark, "layers")
    query = stream_bronze(
        spark, zone, root, fresh_dir(spark, "stream"), CONTRACT, require_complete=False
    )
    query.awaitTermination()
    return _served(spark, root)


def layers_from_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = _zone(pin_utc(spark), sf_dir, "both")
    root = fresh_dir(spark, "layers")
    run_pipeline(spark, zone, root, CONTRACT, require_complete=False)
    return tables.published(spark, root, "daily").drop("source_modified_at")


def _set_times(spark: SparkSession, pattern: str, at: datetime) -> None:
    """Set the modification time of landed files, one per day, respondent and version."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.globStatus(place) or []:
        system.setTimes(status.getPath(), int(at.timestamp() * 1000), -1)


FILES = "respondent=*/year=*/month=*/day=*"


def stream_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream takes the first delivery; all later files then come with times long past."""
    zone, root = fresh_dir(pin_utc(spark), "zone"), fresh_dir(spark, "layers")
    checkpoint = fresh_dir(spark, "stream")

    def drain() -> None:
        query = stream_bronze(spark, zone, root, checkpoint, CONTRACT, require_complete=False)
        query.awaitTermination()

    deliver_days(spark, first_delivered(spark, sf_dir), zone, CONTRACT, complete=False)
    drain()
    known = {r["path"] for r in landing.scan_landing(spark, zone).select("path").collect()}
    deliver_days(spark, delivered(spark, sf_dir), zone, CONTRACT, complete=False)
    for row in landing.scan_landing(spark, zone).select("path").collect():
        if row["path"] not in known:
            _set_times(spark, row["path"], datetime(2020, 1, 1))
    drain()
    return _served(spark, root)


def stream_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries that announce their files; those of the second carry times long past."""
    zone, told, root = (fresh_dir(pin_utc(spark), name) for name in ("zone", "notices", "layers"))
    checkpoint = fresh_dir(spark, "stream")
    for records, old in ((first_delivered(spark, sf_dir), False), (delivered(spark, sf_dir), True)):
        notices.deliver_and_announce(spark, records, zone, told, CONTRACT, complete=False)
        if old:
            _set_times(spark, f"{zone}/{FILES}/version=revision_*/*.txt", datetime(2020, 1, 1))
            _set_times(spark, f"{zone}/{FILES}/version=canonical/*.txt", datetime(2019, 1, 1))
        query = notices.stream_notices(
            spark, zone, told, root, checkpoint, CONTRACT, require_complete=False
        )
        query.awaitTermination()
    return tables.published(spark, root, "history").select(
        *READING_KEY, "value", "value_units", fp.path_version("source_path").alias("version"), "content_hash"
    )


def stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries of history rows, each taken by a query of its own from the same state."""
    path = fresh_dir(pin_utc(spark), "latest")
    for delivery in (FIRST, SECOND, "true"):
        history(spark, sf_dir, delivery).write.mode("append").parquet(f"{path}/history")
        query = latest.stream_latest(spark, f"{path}/history", f"{path}/updates", f"{path}/checkpoint")
        query.awaitTermination()
    return latest.served_latest(spark, f"{path}/updates")


def packed_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of both deliveries, of which the first was packed before the second came."""
    zone, where = fresh_dir(pin_utc(spark), "zone"), fresh_dir(spark, "packed")
    for records in (first_delivered(spark, sf_dir), delivered(spark, sf_dir)):
        packed.pack_zone(spark, landing_zone(spark, zone), where, CONTRACT)
        deliver_days(spark, records, zone, CONTRACT, complete=False)
    files = landing.landing_accept(packed.scan_packed(spark, zone, where), CONTRACT)
    return _record_rows(landing.explode_records(landing.decode_payload(files)))


def landing_zone(spark: SparkSession, zone: str) -> str:
    landing.open_zone(spark, zone)
    return zone


def pipeline_touched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries, then a run after the canonical files got a later time."""
    zone, root = fresh_dir(pin_utc(spark), "zone"), fresh_dir(spark, "layers")
    for records in (first_delivered(spark, sf_dir), delivered(spark, sf_dir)):
        deliver_days(spark, records, zone, CONTRACT, complete=False)
        run_pipeline(spark, zone, root, CONTRACT, require_complete=False)
    _set_times(spark, f"{zone}/{FILES}/version=canonical/*.txt", datetime(2100, 1, 1))
    run_pipeline(spark, zone, root, CONTRACT, require_complete=False)
    return _served(spark, root)


def observed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A, B, A by download time: the readings of A count again, file times play no part."""
    zone, root = fresh_dir(pin_utc(spark), "zone"), fresh_dir(spark, "layers")
    first, both = first_delivered(spark, sf_dir), delivered(spark, sf_dir)
    for day, records in enumerate((first, both, first), 1):
        seen = datetime(2024, 2, day)
        deliver_days(spark, records, zone, OBSERVED, "latest", seen, complete=False)
    _set_times(spark, f"{zone}/{FILES}/version=canonical/*.txt", datetime(2100, 1, 1))
    run_pipeline(spark, zone, root, OBSERVED, require_complete=False)
    return tables.published(spark, root, "latest").select(*READING_KEY, "value")


def complete_days_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with all their hours, through a run with every gate on."""
    root = fresh_dir(pin_utc(spark), "layers")
    whole = _daily(spark, sf_dir).filter(f"hour_count = {CONTRACT.hours_per_day}")
    batch = tables.with_date(history(spark, sf_dir)).join(
        whole.select("date", "respondent"), ["date", "respondent"], "left_semi"
    )
    incremental_refresh(spark, batch, root, CONTRACT)
    return tables.published(spark, root, "daily")


def registered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layers of two deliveries as tables of a database, read in SQL."""
    root, _ = _refreshed(spark, sf_dir)
    database = f"ledger_{uuid.uuid4().hex}"
    tables.register_tables(spark, root, database)
    return spark.sql(
        f"""SELECT d.respondent, count(*) AS days, sum(d.hour_count) AS hours,
              any_value(v.versions) AS versions
            FROM {database}.daily d
            JOIN (SELECT respondent, count(*) AS versions FROM {database}.history GROUP BY respondent) v
              ON v.respondent = d.respondent
            GROUP BY d.respondent"""
    )


QUERIES: dict[str, Query] = {
    # versions
    "latest_per_key": latest_per_key,
    "revision_stats": revision_stats,
    "layer_counts": layer_counts,
    "history_append": history_append,
    "new_versions": new_versions,
    "merge_latest": merge_latest,
    "merge_stats": merge_stats,
    "key_lookup": key_lookup,
    "validity_intervals": validity_intervals,
    "as_of": as_of,
    "preview_latest": preview_latest,
    # layers
    "pivot_hourly": pivot_hourly,
    "newest_hourly": _hourly,
    "forecast_error": forecast_error,
    "merge_hourly": merge_hourly,
    "daily_kpi": daily_kpi,
    "merge_daily": merge_daily,
    "latest_dates": latest_dates,
    "trailing_kpi": trailing_kpi,
    "trailing_refresh": trailing_refresh,
    "weekend_share": weekend_share,
    # quality
    "dq_row_rules": dq_row_rules,
    "dq_duplicates": dq_duplicates,
    "dq_pairing": dq_pairing,
    "dq_hourly_rules": dq_hourly_rules,
    "dq_daily_rules": dq_daily_rules,
    "gated_write": gated_write,
    "dq_complete_days": dq_complete_days,
    "dq_coverage": dq_coverage,
    "dq_declared_total": dq_declared_total,
    "dq_accepted_files": dq_accepted_files,
    "accepted_counts": accepted_counts,
    "duplicate_keys": duplicate_keys,
    "expected_grid": _grid,
    "coverage_gaps": coverage_gaps,
    "coverage_bitmap": coverage_bitmap,
    "day_masks": day_masks,
    "gap_runs": gap_runs,
    # landing
    "landing_accept": landing_accept,
    "parse_landing_path": parse_landing_path,
    "scan_landing": scan_landing,
    "land_days": land_days,
    "ingest_days": ingest_days,
    "decode_payload": decode_payload,
    "content_fingerprint": content_fingerprint,
    "explode_records": explode_records,
    "safe_numeric": safe_numeric,
    "parse_period": parse_period,
    "day_fingerprint": day_fingerprint,
    "record_digest": record_digest,
    "classify_days": classify_days,
    "landing_conflicts": landing_conflicts,
    # compare
    "snapshot_diff": snapshot_diff,
    "changed_fields": changed_fields,
    "diff_summary": diff_summary,
    "digest_diff": snapshot_digest_diff,
    "digest_summary": digest_summary,
    "reconcile": reconcile,
    "reconcile_failures": reconcile_failures,
    "first_present": first_present,
    "normalize_period": normalize_period,
    "read_snapshot": read_snapshot,
    # state and runs
    "processing_range": processing_range,
    "processing_hours": processing_hours,
    "next_checkpoint": next_checkpoint,
    "checkpoint_rules": checkpoint_rules,
    "incremental_refresh": incremental_refresh_daily,
    "refresh_outcome": refresh_outcome,
    "stream_bronze": stream_latest,
    "layers_from_landing": layers_from_landing,
    "stream_late_files": stream_late_files,
    "stream_notices": stream_notices,
    "stream_latest_state": stream_latest_state,
    "packed_zone": packed_zone,
    "pipeline_touched_files": pipeline_touched_files,
    "observed_order": observed_order,
    "complete_days_refresh": complete_days_refresh,
    "registered_tables": registered_tables,
}
