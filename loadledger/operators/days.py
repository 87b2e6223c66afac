"""Whole days as units: fingerprint, classification and write conflicts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadledger.contract import CANONICAL, DAY_KEY

NEW, UNCHANGED, REVISION = "NEW", "UNCHANGED", "REVISION"
WRITE, SKIP, CONFLICT = "write", "skip", "conflict"
WITH_NULLS = "map('ignoreNullFields', 'false')"


def whole_record(names: Sequence[str]) -> str:
    """SQL for a record of these columns as canonical JSON.

    As a variant value a record holds its keys sorted, also those of objects
    within it; it is written without white space, a null field as ``null``.
    """
    fields = ", ".join(f"`{name}`" for name in names)
    return f"to_json(parse_json(to_json(struct({fields}), {WITH_NULLS})))"


def day_records(records: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per day with its records as sorted canonical JSON objects.

    ``records`` carries the declared ``date`` next to the record fields: the
    declared ones and any others a source may send. Where there is a column
    ``record``, that variant is the whole record instead. A repeated reading key fails the
    job, so a day collects no more than one entry per hour and type it holds.
    """
    group = (*DAY_KEY, *extra)
    apart = {"date", "version", *extra}
    if "record" in records.columns:
        whole = "to_json(record)"
    else:
        whole = whole_record([name for name in records.columns if name not in apart])
    keyed = records.groupBy(*group, "period", "type").agg(
        F.expr("count(*) AS n"), F.expr(f"max({whole}) AS record")
    )
    entry = """struct(period, type, CASE WHEN n = 1 THEN record ELSE CAST(raise_error(
        concat_ws(' ', 'duplicate record:', period, respondent, type)) AS STRING) END AS record)"""
    days = keyed.groupBy(*group).agg(F.expr(f"sort_array(collect_list({entry})) AS entries"))
    return days.selectExpr(
        *group,
        "size(entries) AS record_count",
        "concat('[', array_join(transform(entries, e -> e.record), ','), ']') AS records_json",
    )


def day_fingerprint(records: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """SHA-256 over a day's whole records in canonical form.

    Records are sorted, keys are sorted at every depth, a null field is ``null`` and there
    is no white space, so file layout, key order and record order do not matter. Fields
    beyond the declared ones take part: a day in which only one of those changes is another day.
    """
    return day_records(records, extra).select(
        *DAY_KEY, *extra, "record_count", F.sha2("records_json", 256).alias("fingerprint")
    )


def baseline_days(landed: DataFrame, baseline: str = CANONICAL) -> DataFrame:
    """The landed version of each day that a new delivery is compared with.

    ``canonical`` takes the first landed file, ``latest`` the newest version.
    ``landed`` holds (date, respondent, version, fingerprint, source_modified_at,
    source_path).
    """
    if baseline == CANONICAL:
        return landed.filter(F.col("version") == CANONICAL)
    order = Window.partitionBy(*DAY_KEY).orderBy(
        F.col("source_modified_at").desc(), F.col("source_path").desc()
    )
    ranked = landed.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def classify_days(incoming: DataFrame, landed: DataFrame, baseline: str = CANONICAL) -> DataFrame:
    """NEW, UNCHANGED or REVISION for each delivered day, by fingerprint."""
    known = baseline_days(landed, baseline).select(
        *DAY_KEY, F.col("fingerprint").alias("landed_fingerprint")
    )
    status = (
        F.when(F.col("landed_fingerprint").isNull(), F.lit(NEW))
        .when(F.col("landed_fingerprint") == F.col("fingerprint"), F.lit(UNCHANGED))
        .otherwise(F.lit(REVISION))
    )
    judged = incoming.join(known, list(DAY_KEY), "left").withColumn("status", status)
    return judged.select(
        *DAY_KEY,
        "record_count",
        "fingerprint",
        "status",
        F.when(F.col("status") == REVISION, F.col("fingerprint")).alias("revision_id"),
    )


def landing_conflicts(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """What writing each version would do: write it, skip the same content, or conflict.

    Both sides hold (date, respondent, version, fingerprint). A name is never
    written twice, so other content under a known name is a conflict.
    """
    keys = [*DAY_KEY, "version"]
    known = landed.select(*keys, F.col("fingerprint").alias("landed_fingerprint"))
    outcome = (
        F.when(F.col("landed_fingerprint").isNull(), F.lit(WRITE))
        .when(F.col("landed_fingerprint") == F.col("fingerprint"), F.lit(SKIP))
        .otherwise(F.lit(CONFLICT))
    )
    judged = incoming.join(known, keys, "left").withColumn("outcome", outcome)
    return judged.drop("landed_fingerprint")
