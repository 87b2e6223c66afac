"""Readings to one row per hour, with the forecast error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.contract import HOUR_KEY, HOURLY_SCHEMA, NEWEST, SeriesContract
from loadledger.functions.columns import period_sql, sql_text


def _with_errors(wide: DataFrame) -> DataFrame:
    """The hourly columns. The signed error is actual minus forecast; it is null, like
    its size, when one of the two is missing."""
    return wide.selectExpr(
        "*",
        f"{period_sql()} AS period_ts",
        "to_date(period_ts) AS date",
        "actual_demand_mwh - forecast_demand_mwh AS forecast_error_mwh",
        "abs(forecast_error_mwh) AS absolute_error_mwh",
        "greatest(actual_at, forecast_at) AS source_modified_at",
    ).select(*HOURLY_SCHEMA.names)


def pivot_hourly(latest: DataFrame, contract: SeriesContract) -> DataFrame:
    """One row per hour and respondent; the measure types become columns."""
    actual, forecast = sql_text(contract.actual_type), sql_text(contract.forecast_type)
    wide = latest.groupBy(*HOUR_KEY).agg(
        F.expr(f"max(CASE WHEN type = {actual} THEN value END) AS actual_demand_mwh"),
        F.expr(f"max(CASE WHEN type = {forecast} THEN value END) AS forecast_demand_mwh"),
        F.expr(f"max(CASE WHEN type = {actual} THEN source_modified_at END) AS actual_at"),
        F.expr(f"max(CASE WHEN type = {forecast} THEN source_modified_at END) AS forecast_at"),
    )
    return _with_errors(wide)


def newest_hourly(
    history: DataFrame, contract: SeriesContract, newest: Sequence[str] = NEWEST
) -> DataFrame:
    """``pivot_hourly`` of the latest readings, straight from history.

    The newest version of each type is the largest (order, value) pair of its
    hour, so choosing versions and pivoting share one shuffle. Versions fold on
    the map side, as in ``latest_per_key``.
    """
    order = ", ".join(newest)

    def best(kind: str) -> str:
        version = f"struct({order}, value AS value, source_modified_at AS at)"
        return f"max(CASE WHEN type = {sql_text(kind)} THEN {version} END)"

    wide = history.groupBy(*HOUR_KEY).agg(
        F.expr(f"{best(contract.actual_type)} AS actual"),
        F.expr(f"{best(contract.forecast_type)} AS forecast"),
    )
    return _with_errors(
        wide.selectExpr(
            *HOUR_KEY,
            "actual.value AS actual_demand_mwh",
            "forecast.value AS forecast_demand_mwh",
            "actual.at AS actual_at",
            "forecast.at AS forecast_at",
        )
    )


def paired_hours(hourly: DataFrame) -> DataFrame:
    """Hours that have both an actual and a forecast value."""
    return hourly.filter("actual_demand_mwh IS NOT NULL AND forecast_demand_mwh IS NOT NULL")
