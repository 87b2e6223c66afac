"""Completeness as bitmaps: one bit per reading that a day should have.

A day of a respondent is one number whose bits are its hours, type after type.
Rows fold into it by ``bit_or`` before they move, so neither repeated readings
nor a busy respondent make a large group, and what is missing comes out by bit
operations: only gaps ever become rows, never the grid of what is expected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadledger.contract import DAY_KEY, PERIOD_FORMAT, READING_KEY, SeriesContract
from loadledger.functions.columns import period_sql, sql_list, sql_text

MOST_BITS = 63


def _full(contract: SeriesContract) -> int:
    if contract.records_per_day > MOST_BITS:
        raise ValueError(f"a day has {contract.records_per_day} readings; a mask holds {MOST_BITS}")
    return (1 << contract.records_per_day) - 1


def _placed(records: DataFrame, contract: SeriesContract) -> DataFrame:
    """Reading keys with their day and bit; null where the key is none that a day has."""
    kinds = sql_list(contract.types)
    place = f"array_position(array({kinds}), type)"
    hour = f"hour({period_sql()})"
    fits = (
        f"date_format({period_sql()}, {sql_text(PERIOD_FORMAT)}) = period "
        f"AND {place} > 0 AND {hour} < {contract.hours_per_day}"
    )
    return records.selectExpr(
        *READING_KEY,
        f"to_date({period_sql()}) AS date",
        f"CASE WHEN {fits} THEN CAST(({place} - 1) * {contract.hours_per_day} + {hour} AS INT) END AS slot",
    )


def _masks(placed: DataFrame) -> DataFrame:
    bits = placed.filter("slot IS NOT NULL").selectExpr(*DAY_KEY, "shiftleft(1L, slot) AS bit")
    return bits.groupBy(*DAY_KEY).agg(F.expr("bit_or(bit) AS mask"))


def day_masks(records: DataFrame, contract: SeriesContract) -> DataFrame:
    """(date, respondent, mask, readings, missing) of every day that holds a fitting reading.

    Bit ``type * hours + hour`` of the mask stands for a reading, the types in
    the order of the contract.
    """
    full = _full(contract)
    return _masks(_placed(records, contract)).selectExpr(
        *DAY_KEY,
        "mask",
        "CAST(bit_count(mask) AS INT) AS readings",
        f"CAST(bit_count({full}L & ~mask) AS INT) AS missing",
    )


def missing_masks(records: DataFrame, days: DataFrame, contract: SeriesContract) -> DataFrame:
    """(date, respondent, mask): what each of the days (date, respondent) lacks, if anything."""
    found = _masks(_placed(records, contract))
    lacking = days.select(*DAY_KEY).distinct().join(found, list(DAY_KEY), "left")
    rest = lacking.selectExpr(*DAY_KEY, f"{_full(contract)}L & ~coalesce(mask, 0L) AS mask")
    return rest.filter("mask <> 0")


def _readings(masks: DataFrame, contract: SeriesContract) -> DataFrame:
    """The reading keys of the bits that are set."""
    hours = contract.hours_per_day
    slots = f"explode(filter(sequence(0, {contract.records_per_day - 1}), i -> shiftright(mask, i) & 1 = 1)) AS slot"
    return masks.selectExpr("*", slots).selectExpr(
        f"concat(date_format(date, 'yyyy-MM-dd'), 'T', lpad(slot % {hours}, 2, '0')) AS period",
        "respondent",
        f"element_at(array({sql_list(contract.types)}), CAST(slot div {hours} AS INT) + 1) AS type",
        *[name for name in masks.columns if name not in (*DAY_KEY, "mask")],
    )


def coverage_bitmap(records: DataFrame, days: DataFrame, contract: SeriesContract) -> DataFrame:
    """Keys on one side only, as ``missing`` or ``unexpected``, like ``coverage_gaps``.

    ``days`` holds the (date, respondent) that should be complete.
    """
    full = _full(contract)
    placed = _placed(records, contract)
    expected = days.select(*DAY_KEY).distinct().withColumn("_expected", F.lit(True))
    both = expected.join(_masks(placed), list(DAY_KEY), "full_outer")
    gaps = both.selectExpr(
        *DAY_KEY,
        f"CASE WHEN _expected THEN {full}L & ~coalesce(mask, 0L) ELSE mask END AS mask",
        "CASE WHEN _expected THEN 'missing' ELSE 'unexpected' END AS gap",
    )
    foreign = placed.filter("slot IS NULL").select(*READING_KEY).distinct()
    return _readings(gaps.filter("mask <> 0"), contract).unionByName(
        foreign.withColumn("gap", F.lit("unexpected"))
    )


def _runs_of_days(masks: DataFrame, contract: SeriesContract) -> DataFrame:
    """Runs of set bits within each day and type: a run starts at a bit whose lower neighbour is
    not set and ends at one whose upper neighbour is not; both come in the same order."""
    hours = contract.hours_per_day
    kinds = ", ".join(
        f"struct({sql_text(kind)} AS type, shiftright(mask, {n * hours}) & {(1 << hours) - 1}L AS bits)"
        for n, kind in enumerate(contract.types)
    )
    each = masks.selectExpr(*DAY_KEY, f"inline(array({kinds}))").filter("bits <> 0")

    def places(bits: str) -> str:
        return f"filter(sequence(0, {hours - 1}), i -> shiftright({bits}, i) & 1 = 1)"

    starts = places("bits & ~shiftleft(bits, 1)") + " AS a"
    ends = places("bits & ~shiftright(bits, 1)") + " AS b"
    listed = each.selectExpr("respondent", "type", "date", starts, ends)
    return listed.selectExpr("respondent", "type", "date", "inline(arrays_zip(a, b))").selectExpr(
        "respondent",
        "type",
        "CAST(date AS TIMESTAMP) + make_interval(0, 0, 0, 0, a) AS first_ts",
        "CAST(date AS TIMESTAMP) + make_interval(0, 0, 0, 0, b) AS last_ts",
    )


def gap_runs(records: DataFrame, days: DataFrame, contract: SeriesContract) -> DataFrame:
    """(respondent, type, first_period, last_period, hours): runs of missing hours.

    Hours fold into runs within a day first, so what is put in order per series
    are runs of days, not hours. A run that reaches the end of a day continues in
    one that begins the next; hours of days that are not expected end it.
    """
    if contract.hours_per_day != 24:
        raise ValueError("runs over midnight need days of 24 hours")
    runs = _runs_of_days(missing_masks(records, days, contract), contract)
    series = Window.partitionBy("respondent", "type").orderBy("first_ts")
    follows = F.lag("last_ts").over(series) + F.expr("interval 1 hour") == F.col("first_ts")
    started = runs.withColumn("starts", F.when(follows, 0).otherwise(1))
    islands = started.withColumn("island", F.sum("starts").over(series))
    return (
        islands.groupBy("respondent", "type", "island")
        .agg(F.min("first_ts").alias("a"), F.max("last_ts").alias("b"))
        .selectExpr(
            "respondent",
            "type",
            f"date_format(a, {sql_text(PERIOD_FORMAT)}) AS first_period",
            f"date_format(b, {sql_text(PERIOD_FORMAT)}) AS last_period",
            "CAST((unix_seconds(b) - unix_seconds(a)) div 3600 + 1 AS BIGINT) AS hours",
        )
    )

