"""Daily and trailing key figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadledger.contract import DAY_KEY, KPI_DAYS, SeriesContract
from loadledger.functions.columns import exact_sum_sql
from loadledger.operators.hourly import paired_hours


def daily_kpi(hourly: DataFrame) -> DataFrame:
    """One row per day and respondent.

    Averages are an order-independent sum over the count of non-null values.
    """
    totals = hourly.groupBy(*DAY_KEY).agg(
        F.expr("count(*) AS hour_count"),
        F.expr(f"CAST({exact_sum_sql('actual_demand_mwh')} AS DOUBLE) AS total_daily_energy_mwh"),
        F.expr("count(actual_demand_mwh) AS actuals"),
        F.expr("max(actual_demand_mwh) AS peak_demand_mwh"),
        F.expr(f"CAST({exact_sum_sql('absolute_error_mwh')} AS DOUBLE) AS abs_error"),
        F.expr("count(absolute_error_mwh) AS errors"),
        F.expr("max(source_modified_at) AS source_modified_at"),
    )
    return totals.selectExpr(
        *DAY_KEY,
        "hour_count",
        "try_divide(total_daily_energy_mwh, actuals) AS avg_hourly_demand_mwh",
        "peak_demand_mwh",
        "total_daily_energy_mwh",
        "try_divide(abs_error, errors) AS mae_mwh",
        "source_modified_at",
    )


def with_completeness(daily: DataFrame, contract: SeriesContract) -> DataFrame:
    return daily.withColumn("is_complete", F.col("hour_count") == contract.hours_per_day)


def latest_dates(daily: DataFrame, n: int) -> DataFrame:
    """The last ``n`` dates present, newest first."""
    return daily.select("date").distinct().orderBy(F.col("date").desc()).limit(n)


def trailing_kpi(
    hourly: DataFrame, contract: SeriesContract, windows: Sequence[int] = KPI_DAYS
) -> DataFrame:
    """Key figures of each respondent's last N days that have paired hours.

    All windows come from one pass: hours fold into days before anything is
    ranked, and a day then counts towards every window it lies in.
    """
    days = paired_hours(hourly).groupBy(*DAY_KEY).agg(
        F.expr("count(*) AS hours"),
        F.expr(f"{exact_sum_sql('actual_demand_mwh')} AS energy"),
        F.expr(f"{exact_sum_sql('absolute_error_mwh')} AS abs_error"),
        F.expr("max(actual_demand_mwh) AS peak"),
    )
    sums = (
        in_windows(days, windows)
        .groupBy("respondent", "window_days")
        .agg(
            F.expr("min(date) AS first_date"),
            F.expr("max(date) AS last_date"),
            F.expr("sum(hours) AS hour_count"),
            F.expr("CAST(sum(energy) AS DOUBLE) AS total_energy_mwh"),
            F.expr("max(peak) AS peak_demand_mwh"),
            F.expr("CAST(sum(abs_error) AS DOUBLE) AS abs_error"),
        )
    )
    return sums.selectExpr(
        "respondent",
        "window_days",
        "first_date",
        "last_date",
        "hour_count",
        f"hour_count = window_days * {contract.hours_per_day} AS is_covered",
        "total_energy_mwh",
        "peak_demand_mwh",
        "try_divide(abs_error, hour_count) AS mae_mwh",
        "100D * (1D - try_divide(abs_error, total_energy_mwh)) AS accuracy_pct",
    )


def in_windows(days: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Each respondent's last days, once per window of N days that they lie in."""
    newest = Window.partitionBy("respondent").orderBy(F.col("date").desc())
    ranked = days.withColumn("day_rank", F.row_number().over(newest))
    reached = ranked.filter(f"day_rank <= {max(windows)}")
    listed = ", ".join(str(n) for n in windows)
    spans = f"explode(filter(array({listed}), n -> n >= day_rank)) AS window_days"
    return reached.selectExpr("*", spans)


def weekend_share(daily: DataFrame) -> DataFrame:
    """Part of each respondent's energy that fell on Saturdays and Sundays."""
    weekend = "CASE WHEN dayofweek(date) IN (1, 7) THEN total_daily_energy_mwh END"
    sums = daily.groupBy("respondent").agg(
        F.expr(f"CAST(coalesce({exact_sum_sql(weekend)}, 0) AS DOUBLE) AS weekend_energy_mwh"),
        F.expr(f"CAST({exact_sum_sql('total_daily_energy_mwh')} AS DOUBLE) AS total_energy_mwh"),
    )
    return sums.selectExpr(
        "*", "try_divide(weekend_energy_mwh, total_energy_mwh) AS weekend_share"
    )
