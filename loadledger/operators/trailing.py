"""Trailing key figures kept up by differences.

What is kept are sums of days and of windows, as decimals, so that taking the
old figures of an hour away and adding the new ones gives exactly the sums that
a fresh start would give. A peak only rises by itself; where the value that was
the peak has left, it alone is looked up again, among the hours of that day or the
days of that window. Days and windows that no change reaches are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadledger.contract import DAY_KEY, EXACT, HOUR_KEY, KPI_DAYS, SeriesContract
from loadledger.functions.columns import exact_sum_sql
from loadledger.operators.daily import in_windows
from loadledger.operators.hourly import paired_hours

SUMS = ("hours", "energy", "abs_error")
WINDOW_KEY = ("respondent", "window_days")
_KEPT = ("actual_demand_mwh", "absolute_error_mwh")


def day_figures(hourly: DataFrame) -> DataFrame:
    """(date, respondent, hours, energy, abs_error, peak) of paired hours."""
    return paired_hours(hourly).groupBy(*DAY_KEY).agg(
        F.expr("count(*) AS hours"),
        F.expr(f"{exact_sum_sql('actual_demand_mwh')} AS energy"),
        F.expr(f"{exact_sum_sql('absolute_error_mwh')} AS abs_error"),
        F.expr("max(actual_demand_mwh) AS peak"),
    )


def window_figures(days: DataFrame, windows: Sequence[int] = KPI_DAYS) -> DataFrame:
    """(respondent, window_days, first_date, last_date, hours, energy, abs_error, peak)."""
    return in_windows(days, windows).groupBy(*WINDOW_KEY).agg(
        F.expr("min(date) AS first_date"),
        F.expr("max(date) AS last_date"),
        *[F.expr(f"sum({name}) AS {name}") for name in SUMS],
        F.expr("max(peak) AS peak"),
    )


def served_windows(figures: DataFrame, contract: SeriesContract) -> DataFrame:
    """Kept figures of windows in the columns of ``trailing_kpi``."""
    plain = figures.selectExpr(
        "*", "CAST(energy AS DOUBLE) AS energy_", "CAST(abs_error AS DOUBLE) AS error_"
    )
    return plain.selectExpr(
        *WINDOW_KEY,
        "first_date",
        "last_date",
        "hours AS hour_count",
        f"hours = window_days * {contract.hours_per_day} AS is_covered",
        "energy_ AS total_energy_mwh",
        "peak AS peak_demand_mwh",
        "try_divide(error_, hours) AS mae_mwh",
        "100D * (1D - try_divide(error_, energy_)) AS accuracy_pct",
    )


def hour_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed rows (date, respondent, sign, value, error): old figures of an hour with -1, new ones with +1.

    Both sides hold an hour once; hours whose figures stay give no rows, nor do hours without both types.
    """
    sides = [
        paired_hours(df).selectExpr(*HOUR_KEY, "date", f"{sign} AS sign", *_KEPT)
        for df, sign in ((before, -1), (after, 1))
    ]
    both = sides[0].unionByName(sides[1])
    # Equal figures cancel; what is left of an hour is its old row, its new row, or both.
    left = both.groupBy(*HOUR_KEY, "date", *_KEPT).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    return left.selectExpr(
        *DAY_KEY, "sign", "actual_demand_mwh AS value", "absolute_error_mwh AS error"
    )


def day_changes(signed: DataFrame) -> DataFrame:
    """Signed rows folded to days: what to add, the greatest value that came and the greatest that left."""
    return signed.groupBy(*DAY_KEY).agg(
        F.expr("sum(sign) AS hours"),
        F.expr(f"sum(CAST(sign * value AS {EXACT})) AS energy"),
        F.expr(f"sum(CAST(sign * error AS {EXACT})) AS abs_error"),
        F.expr("max(CASE WHEN sign > 0 THEN value END) AS came"),
        F.expr("max(CASE WHEN sign < 0 THEN value END) AS went"),
    )


def _with_peaks(moved: DataFrame, members: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Peaks after a change; only where the old peak left, from the members again."""
    keys = list(keys)
    lost = moved.filter("went >= old_peak AND NOT coalesce(came >= went, false)").select(*keys)
    again = members.join(lost, keys, "left_semi").groupBy(*keys).agg(F.max(value).alias("found"))
    peak = F.coalesce("found", F.greatest("old_peak", "came")).alias("peak")
    return moved.join(again, keys, "left").select(*[c for c in moved.columns if c not in ("old_peak", "came", "went")], peak)


def changed_days(days: DataFrame, signed: DataFrame, after: DataFrame) -> DataFrame:
    """New figures of the days that changed; ``hours`` is 0 where none are left.

    ``days`` are the kept figures, ``after`` the hours as they are now, of which
    only those of days that lost their peak are read.
    """
    changes = day_changes(signed).alias("c")
    known = days.join(changes.select(*DAY_KEY), list(DAY_KEY), "left_semi").alias("k")
    moved = changes.join(known, list(DAY_KEY), "left").selectExpr(
        *DAY_KEY,
        *[f"coalesce(k.{n}, 0) + c.{n} AS {n}" for n in SUMS],
        "k.peak AS old_peak",
        "came",
        "went",
    )
    return _with_peaks(moved, paired_hours(after), DAY_KEY, "actual_demand_mwh").select(
        *DAY_KEY, F.col("hours").cast("long"), *[F.col(n).cast("decimal(38,6)").alias(n) for n in SUMS[1:]], "peak"
    )


def days_after(days: DataFrame, changed: DataFrame) -> DataFrame:
    """Kept figures of all days with the changed ones in place."""
    names = [*DAY_KEY, *SUMS, "peak"]
    kept = days.join(changed.select(*DAY_KEY), list(DAY_KEY), "left_anti").select(*names)
    return kept.unionByName(changed.filter("hours > 0").select(*names))


def touched_windows(days: DataFrame, changed: DataFrame, windows: Sequence[int] = KPI_DAYS) -> DataFrame:
    """Respondents with a change within reach of any window: not before their oldest day in one."""
    whom = changed.select("respondent").distinct()
    last = days.join(whom, "respondent", "left_semi").select(*DAY_KEY)
    newest = Window.partitionBy("respondent").orderBy(F.col("date").desc())
    ranked = last.withColumn("day_rank", F.row_number().over(newest)).filter(f"day_rank <= {max(windows)}")
    reach = ranked.groupBy("respondent").agg(F.min("date").alias("oldest"), F.count(F.lit(1)).alias("n"))
    near = changed.join(reach, "respondent", "left").filter(
        f"oldest IS NULL OR n < {max(windows)} OR date >= oldest"
    )
    return near.select("respondent").distinct()


def changed_windows(
    windows: DataFrame,
    days: DataFrame,
    changed: DataFrame,
    spans: Sequence[int] = KPI_DAYS,
) -> DataFrame:
    """New figures of the windows that a change reaches; ``hours`` is 0 where no day is left.

    The days of a window before and after are set against each other with their
    signs; days that stay as they are cancel, and the rest is added to the kept sums.
    """
    whom = touched_windows(days, changed, spans)
    mine = days.join(whom, "respondent", "left_semi")
    theirs = changed.join(whom, "respondent", "left_semi")
    old, new = in_windows(mine, spans), in_windows(days_after(mine, theirs), spans)
    kept = (*WINDOW_KEY, "date", *SUMS, "peak")
    signed = old.selectExpr(*kept, "-1 AS sign").unionByName(new.selectExpr(*kept, "1 AS sign"))
    moved_days = signed.groupBy(*kept).agg(F.sum("sign").alias("sign")).filter("sign <> 0")
    sums = moved_days.groupBy(*WINDOW_KEY).agg(
        *[F.expr(f"sum(sign * {n}) AS {n}") for n in SUMS],
        F.expr("max(CASE WHEN sign > 0 THEN peak END) AS came"),
        F.expr("max(CASE WHEN sign < 0 THEN peak END) AS went"),
    )
    known = windows.join(whom, "respondent", "left_semi").alias("k")
    moved = sums.alias("c").join(known, list(WINDOW_KEY), "left").selectExpr(
        *WINDOW_KEY,
        *[f"coalesce(k.{n}, 0) + c.{n} AS {n}" for n in SUMS],
        "k.peak AS old_peak",
        "came",
        "went",
    )
    span = new.groupBy(*WINDOW_KEY).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    peaks = _with_peaks(moved, new, WINDOW_KEY, "peak")
    return peaks.join(span, list(WINDOW_KEY), "left").select(
        *WINDOW_KEY, "first_date", "last_date", F.col("hours").cast("long"),
        *[F.col(n).cast("decimal(38,6)").alias(n) for n in SUMS[1:]], "peak",
    )


def windows_after(windows: DataFrame, changed: DataFrame) -> DataFrame:
    """Kept figures of all windows with the changed ones in place."""
    names = changed.columns
    kept = windows.join(changed.select(*WINDOW_KEY), list(WINDOW_KEY), "left_anti").select(*names)
    return kept.unionByName(changed.filter("hours > 0"))
