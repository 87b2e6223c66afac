"""What a revised series looks like: its schemas, keys and fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Formats, names and domains that landed files and published tables use.
PERIOD_FORMAT = "yyyy-MM-dd'T'HH"
CANONICAL = "canonical"
LAST_HOUR = 23
KPI_DAYS = (3, 7, 10)
ABS_TOLERANCE = 0.01
REL_TOLERANCE = 1e-9
RECORD_FIELDS = (
    "period",
    "respondent",
    "respondent-name",
    "type",
    "type-name",
    "value",
    "value-units",
)

READING_KEY = ("period", "respondent", "type")
VERSION_KEY = ("source_path", "content_hash", *READING_KEY)
HOUR_KEY = ("period", "respondent")
DAY_KEY = ("date", "respondent")

# Newest first. The content hash decides between two contents that were seen
# under one path with one modification time.
NEWEST = ("source_modified_at", "source_path", "content_hash")

# Order-independent sums: doubles are summed as decimals, so a rerun over other
# partitions gives the same bits and change detection sees no false update.
EXACT = "decimal(28,6)"


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RECORD_FIELDS])

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("data", T.ArrayType(RECORD_SCHEMA)),
                    T.StructField("total", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "ingestion_metadata",
            T.StructType([T.StructField("downloaded_at_utc", T.StringType())]),
        ),
    ]
)

FILE_SCHEMA = _schema(
    path=T.StringType(),
    modificationTime=T.TimestampType(),
    length=T.LongType(),
    content=T.BinaryType(),
)

HISTORY_SCHEMA = _schema(
    period=T.StringType(),
    respondent=T.StringType(),
    type=T.StringType(),
    value=T.DoubleType(),
    value_units=T.StringType(),
    source_path=T.StringType(),
    source_modified_at=T.TimestampType(),
    content_hash=T.StringType(),
)
LATEST_SCHEMA = HISTORY_SCHEMA

HOURLY_SCHEMA = _schema(
    period=T.StringType(),
    period_ts=T.TimestampType(),
    date=T.DateType(),
    respondent=T.StringType(),
    actual_demand_mwh=T.DoubleType(),
    forecast_demand_mwh=T.DoubleType(),
    forecast_error_mwh=T.DoubleType(),
    absolute_error_mwh=T.DoubleType(),
    source_modified_at=T.TimestampType(),
)

DAILY_SCHEMA = _schema(
    date=T.DateType(),
    respondent=T.StringType(),
    hour_count=T.LongType(),
    avg_hourly_demand_mwh=T.DoubleType(),
    peak_demand_mwh=T.DoubleType(),
    total_daily_energy_mwh=T.DoubleType(),
    mae_mwh=T.DoubleType(),
    source_modified_at=T.TimestampType(),
)

HOURLY_MEASURES = (
    "actual_demand_mwh",
    "forecast_demand_mwh",
    "forecast_error_mwh",
    "absolute_error_mwh",
)
DAILY_MEASURES = (
    "hour_count",
    "avg_hourly_demand_mwh",
    "peak_demand_mwh",
    "total_daily_energy_mwh",
    "mae_mwh",
)


@dataclass(frozen=True)
class SeriesContract:
    """Domain of one family of series.

    ``respondents=None`` leaves the respondent domain open, for feeds with more
    of them than a literal list should hold. With ``by_observation`` versions are
    ordered by the download time in their payload, where there is one, instead of
    the modification time of their file.
    """

    respondents: tuple[str, ...] | None
    file_prefix: str
    initial_date: str
    actual_type: str = "D"
    forecast_type: str = "DF"
    unit: str = "megawatthours"
    hours_per_day: int = 24
    lookback_days: int = 1
    lookback_hours: int = 24
    by_observation: bool = False

    @property
    def types(self) -> tuple[str, str]:
        return (self.actual_type, self.forecast_type)

    @property
    def records_per_day(self) -> int:
        return self.hours_per_day * len(self.types)
