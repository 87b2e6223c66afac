"""Kept trailing figures, brought up to date with each delivery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.contract import KPI_DAYS
from loadledger.operators.trailing import (
    changed_days,
    changed_windows,
    day_figures,
    days_after,
    hour_changes,
    window_figures,
    windows_after,
)

EXACT_SUMS = ("energy", "abs_error")
# Kept by respondent, so that a delivery reads the folders of those it changes.
BY = "respondent"
SUMS = "hours bigint, energy decimal(38,6), abs_error decimal(38,6), peak double"
DAYS = f"date date, {SUMS}, respondent string"
WINDOWS = f"window_days int, first_date date, last_date date, {SUMS}, respondent string"


def _write(df: DataFrame, path: str) -> DataFrame:
    df = df.select(*[F.col(n).cast("decimal(38,6)").alias(n) if n in EXACT_SUMS else n for n in df.columns])
    df.repartition(BY).write.partitionBy(BY).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_figures(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Kept figures of days and of windows."""
    days = spark.read.schema(DAYS).parquet(f"{path}/days")
    return days, spark.read.schema(WINDOWS).parquet(f"{path}/windows")


def start_trailing(hourly: DataFrame, path: str, windows: Sequence[int] = KPI_DAYS) -> None:
    """Figures from all hours, under ``path``."""
    days = _write(day_figures(hourly), f"{path}/days")
    _write(window_figures(days, windows), f"{path}/windows")


def refresh_trailing(
    spark: SparkSession,
    before: DataFrame,
    after: DataFrame,
    kept: str,
    path: str,
    windows: Sequence[int] = KPI_DAYS,
) -> DataFrame:
    """Figures under ``kept`` with the change from ``before`` to ``after``, under ``path``; its windows.

    The two hold the hours of the dates that a delivery touches, old and new.
    Of kept figures only those of respondents with changes are compared; all others
    are carried over as they are.
    """
    days, held = read_figures(spark, kept)
    signed = hour_changes(before, after)
    signed.write.parquet(f"{path}/signed")
    signed = spark.read.schema(signed.schema).parquet(f"{path}/signed")
    moved = _write(changed_days(days, signed, after), f"{path}/changed")
    new = changed_windows(held, days, moved, windows)
    _write(days_after(days, moved), f"{path}/days")
    return _write(windows_after(held, new), f"{path}/windows")
