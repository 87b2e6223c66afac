"""The layers as one lazy query over history, without stored tables in between."""

from __future__ import annotations

from pyspark.sql import DataFrame

from loadledger.contract import SeriesContract
from loadledger.operators.daily import daily_kpi
from loadledger.operators.hourly import newest_hourly, paired_hours


def hourly_from_history(history: DataFrame, contract: SeriesContract) -> DataFrame:
    return newest_hourly(history, contract)


def daily_from_history(history: DataFrame, contract: SeriesContract) -> DataFrame:
    """Daily figures over paired hours; the hourly gate lets no others through."""
    return daily_kpi(paired_hours(hourly_from_history(history, contract)))
