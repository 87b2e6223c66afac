"""Where an incremental run starts, and how far it has come.

State is a small DataFrame (respondent, last_uploaded_hour), one row per
respondent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.contract import LAST_HOUR, PERIOD_FORMAT, SeriesContract
from loadledger.functions.columns import column, parse_period


def processing_range(
    state: DataFrame, contract: SeriesContract, end_date: Column | str
) -> DataFrame:
    """Dates to process: from the lookback before the last day, never before the first.

    ``has_work`` is false when the range is empty.
    """
    initial = F.lit(contract.initial_date).cast("date")
    last_day = F.to_date(parse_period("last_uploaded_hour"))
    start = F.greatest(initial, F.date_sub(last_day, contract.lookback_days))
    end = column(end_date).cast("date")
    return state.select(
        "respondent",
        start.alias("start_date"),
        end.alias("end_date"),
        (start <= end).alias("has_work"),
    )


def processing_hours(state: DataFrame, contract: SeriesContract) -> DataFrame:
    """First hour to fetch when state counts hours; the last hour is part of the lookback."""
    initial = F.lit(f"{contract.initial_date} 00:00:00").cast("timestamp")
    back = F.make_interval(hours=F.lit(contract.lookback_hours - 1))
    start = F.greatest(initial, parse_period("last_uploaded_hour") - back)
    return state.select("respondent", F.date_format(start, PERIOD_FORMAT).alias("start_hour"))


def batch_checkpoint(records: DataFrame) -> DataFrame:
    """Newest hour per respondent in a batch of records."""
    return records.groupBy("respondent").agg(F.max("period").alias("last_uploaded_hour"))


def day_checkpoint(days: DataFrame) -> DataFrame:
    """Last hour of the newest stored day per respondent."""
    last = F.date_format(F.max("date"), f"yyyy-MM-dd'T{LAST_HOUR}'")
    return days.groupBy("respondent").agg(last.alias("last_uploaded_hour"))


def next_checkpoint(previous: DataFrame, reached: DataFrame) -> DataFrame:
    """State after a run. It never moves back, and a respondent never drops out."""
    both = previous.select("respondent", "last_uploaded_hour").unionByName(
        reached.select("respondent", "last_uploaded_hour")
    )
    return both.groupBy("respondent").agg(F.max("last_uploaded_hour").alias("last_uploaded_hour"))
