"""Differences between two snapshots, and their reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.contract import KPI_DAYS, READING_KEY, RECORD_FIELDS, SeriesContract
from loadledger.functions.columns import (
    close_sql,
    exact_sum_sql,
    first_present,
    normalize_date,
    normalize_hour,
    sql_text,
)
from loadledger.operators.daily import in_windows


def changed_fields(names: Sequence[str], left: str = "mine", right: str = "theirs") -> Column:
    """Names of the fields that differ between two aliased rows; null equals null."""
    tests = ", ".join(
        f"CASE WHEN NOT ({left}.`{n}` <=> {right}.`{n}`) THEN {sql_text(n)} END" for n in names
    )
    return F.expr(f"array_compact(array({tests}))")


def snapshot_diff(
    mine: DataFrame,
    theirs: DataFrame,
    keys: Sequence[str] = READING_KEY,
    fields: Sequence[str] = RECORD_FIELDS,
    value: str = "value",
    unit: str = "value-units",
) -> DataFrame:
    """How each key of ``mine`` stands against ``theirs``.

    ``missing`` is absent from theirs, ``extra`` from mine. A common key is a
    value change when the value differs, a metadata change when only another
    field does, else equal. Keys are unique on both sides.
    """
    left = mine.withColumn("_mine", F.lit(True)).alias("mine")
    right = theirs.withColumn("_theirs", F.lit(True)).alias("theirs")
    same_key = F.expr(" AND ".join(f"mine.`{k}` = theirs.`{k}`" for k in keys))
    differing = changed_fields([n for n in fields if n not in keys])
    paired = left.join(right, same_key, "full_outer").withColumn(
        "changed_fields", F.when(F.expr("_mine AND _theirs"), differing)
    )
    return paired.selectExpr(
        *[f"coalesce(mine.`{k}`, theirs.`{k}`) AS `{k}`" for k in keys],
        f"""CASE WHEN _theirs IS NULL THEN 'missing' WHEN _mine IS NULL THEN 'extra'
            WHEN array_contains(changed_fields, {sql_text(value)}) THEN 'value_change'
            WHEN size(changed_fields) > 0 THEN 'metadata_change' ELSE 'equal' END AS status""",
        f"theirs.`{value}` AS old_value",
        f"mine.`{value}` AS new_value",
        f"coalesce(mine.`{unit}`, theirs.`{unit}`) AS unit",
        "changed_fields",
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    """Keys per outcome."""
    return diff.groupBy("status").agg(F.expr("count(*) AS key_count"))


def _side_by_side(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """One row per key with the measures and row counts of both sides.

    Rows of a key fold together before the shuffle, so repeated keys neither
    multiply nor pile up.
    """

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        return df.selectExpr(
            *keys,
            f"1 AS {mine}_n",
            f"0 AS {other}_n",
            *[f"CAST({m} AS DOUBLE) AS {mine}_{m}" for m in measures],
            *[f"CAST(NULL AS DOUBLE) AS {other}_{m}" for m in measures],
        )

    both = side(left, "l", "r").unionByName(side(right, "r", "l"))
    return both.groupBy(*keys).agg(
        F.expr("sum(l_n) AS l_n"),
        F.expr("sum(r_n) AS r_n"),
        *[F.expr(f"max({s}_{m}) AS {s}_{m}") for m in measures for s in ("l", "r")],
    )


def _stacked(rows: Sequence[tuple[int, str, str, str]]) -> str:
    """SQL turning one row of totals into rows (ordinal, check, compared, failed)."""
    entries = ", ".join(
        f"{ordinal}, {sql_text(label)}, CAST({compared} AS BIGINT), CAST({failed} AS BIGINT)"
        for ordinal, label, compared, failed in rows
    )
    return f"stack({len(rows)}, {entries}) AS (ordinal, check, compared, failed)"


def _judged(pairs: DataFrame, measures: Sequence[str], prefix: str) -> DataFrame:
    """Per key, 0 or 1 for each thing that can be wrong with it."""
    common = "l_n > 0 AND r_n > 0"
    tests = {
        "repeated": "l_n > 1 OR r_n > 1",
        "common": common,
        "one_sided": f"NOT ({common})",
        **{f"off_{m}": f"{common} AND NOT coalesce({close_sql(f'l_{m}', f'r_{m}')}, false)" for m in measures},
    }
    flags = [f"CAST({test} AS INT) AS {prefix}{name}" for name, test in tests.items()]
    return pairs.selectExpr("*", f"l_n AS {prefix}left", f"r_n AS {prefix}right", *flags)


def _counted(measures: Sequence[str], prefix: str) -> list[str]:
    names = ["left", "right", "repeated", "common", "one_sided", *[f"off_{m}" for m in measures]]
    return [f"{prefix}{name}" for name in names]


def _check_rows(grain: str, measures: dict[str, str], prefix: str) -> list[tuple[str, str, str]]:
    return [
        (f"{grain} row count", "1", f"{prefix}left <> {prefix}right"),
        (f"{grain} keys unique", "1", f"{prefix}repeated > 0"),
        (f"{grain} keys match", "1", f"{prefix}one_sided > 0"),
        *[(f"{grain} {label}", f"{prefix}common", f"{prefix}off_{m}") for m, label in measures.items()],
    ]


def _window_checks(
    days: DataFrame, contract: SeriesContract, windows: Sequence[int], first: int
) -> DataFrame:
    """Coverage and energy of each respondent's last published days, hours against days."""
    selected = in_windows(days.filter("d_right > 0").withColumnRenamed("day_key", "date"), windows)
    sums = selected.groupBy("respondent", "window_days").agg(
        F.expr("sum(h_left) AS hours"),
        F.expr("CAST(sum(hour_energy) AS DOUBLE) AS hour_energy"),
        F.expr(f"CAST({exact_sum_sql('r_total_daily_energy_mwh')} AS DOUBLE) AS day_energy"),
    )
    covered = f"coalesce(hours = window_days * {contract.hours_per_day}, false)"
    agrees = f"coalesce({close_sql('hour_energy', 'day_energy')}, false)"
    totals = sums.agg(
        *[
            F.expr(f"count(CASE WHEN window_days = {n} {test} THEN 1 END) AS {name}_{n}")
            for n in windows
            for name, test in (
                ("seen", ""),
                ("uncovered", f"AND NOT {covered}"),
                ("off", f"AND NOT {agrees}"),
            )
        ]
    )
    rows = []
    for n in windows:
        rows.append((f"{n}-day hourly coverage", f"seen_{n}", f"uncovered_{n}"))
        rows.append((f"{n}-day total energy", f"seen_{n}", f"off_{n}"))
    return totals.selectExpr(_stacked([(first + i, *row) for i, row in enumerate(rows)]))


HOUR_CHECKS = {"actual_demand_mwh": "actual", "forecast_demand_mwh": "forecast"}
DAY_CHECKS = {"total_daily_energy_mwh": "energy", "peak_demand_mwh": "peak", "mae_mwh": "MAE"}


def with_alternatives(df: DataFrame, names: dict[str, Sequence[str]]) -> DataFrame:
    """Numbers under the names that the checks use, each from the first of its candidates that holds one."""
    found = {
        name: first_present(df, [name, *others], numeric=True, strict=False)
        for name, others in names.items()
    }
    return df.withColumns(found)


def _hour_pairs(hourly: DataFrame, published: DataFrame) -> DataFrame:
    sides = [df.withColumn("hour_key", normalize_hour("period")) for df in (hourly, published)]
    pairs = _side_by_side(*sides, ["hour_key", "respondent"], list(HOUR_CHECKS))
    return _judged(pairs, list(HOUR_CHECKS), "h_")


def _day_pairs(daily: DataFrame, published: DataFrame) -> DataFrame:
    sides = [df.withColumn("day_key", normalize_date("date")) for df in (daily, published)]
    pairs = _side_by_side(*sides, ["day_key", "respondent"], list(DAY_CHECKS))
    return _judged(pairs, list(DAY_CHECKS), "d_")


def reconcile(
    hourly: DataFrame,
    published_hourly: DataFrame,
    daily: DataFrame,
    published_daily: DataFrame,
    contract: SeriesContract,
    windows: Sequence[int] = KPI_DAYS,
) -> DataFrame:
    """Rows (ordinal, check, compared, failed, passed) for two hourly and daily datasets.

    Counts and key sets must agree, common keys must agree within tolerance,
    and the energy of the last N days must be the same from hours and from days.
    Hours fold into days once; all checks come from those. Where published
    columns have other names, see ``with_alternatives``; for the keys that fail,
    ``reconcile_failures``.
    """
    hours, measures = _counted(list(HOUR_CHECKS), "h_"), _counted(list(DAY_CHECKS), "d_")
    folded = (
        _hour_pairs(hourly, published_hourly)
        .withColumn("day_key", F.substring("hour_key", 1, 10))
        .groupBy("day_key", "respondent")
        .agg(
            *[F.sum(name).alias(name) for name in hours],
            F.expr(f"{exact_sum_sql('l_actual_demand_mwh')} AS hour_energy"),
        )
    )
    days = folded.join(_day_pairs(daily, published_daily), ["day_key", "respondent"], "full_outer")
    totals = days.agg(*[F.expr(f"coalesce(sum({name}), 0) AS {name}") for name in (*hours, *measures)])
    rows = [*_check_rows("hourly", HOUR_CHECKS, "h_"), *_check_rows("daily", DAY_CHECKS, "d_")]
    checks = totals.selectExpr(_stacked([(1 + i, *row) for i, row in enumerate(rows)]))
    checks = checks.unionByName(_window_checks(days, contract, windows, 1 + len(rows)))
    return checks.selectExpr("*", "failed = 0 AS passed")


def reconcile_failures(
    hourly: DataFrame, published_hourly: DataFrame, daily: DataFrame, published_daily: DataFrame
) -> DataFrame:
    """(grain, key, respondent, failures) of every hour and day that breaks a check."""

    def failing(pairs: DataFrame, grain: str, key: str, measures: dict[str, str], prefix: str) -> DataFrame:
        tests = {"repeated": "repeated", "one_sided": "one-sided"}
        tests |= {f"off_{m}": label for m, label in measures.items()}
        listed = ", ".join(
            f"CASE WHEN {prefix}{name} = 1 THEN {sql_text(label)} END" for name, label in tests.items()
        )
        named = pairs.selectExpr(
            f"{sql_text(grain)} AS grain", f"{key} AS key", "respondent",
            f"array_join(array_compact(array({listed})), ',') AS failures",
        )
        return named.filter("failures <> ''")

    hours = failing(_hour_pairs(hourly, published_hourly), "hour", "hour_key", HOUR_CHECKS, "h_")
    days = failing(_day_pairs(daily, published_daily), "day", "day_key", DAY_CHECKS, "d_")
    return hours.unionByName(days)
