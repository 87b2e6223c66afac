"""Small series for the tests, built in plain Python."""

from __future__ import annotations

import json
import os
from datetime import date, datetime, timedelta
from pathlib import Path

from loadledger.contract import HISTORY_SCHEMA, RECORD_SCHEMA, SeriesContract
from pyspark.sql import types as T

CONTRACT = SeriesContract(("US48",), "eia_us48", "2026-09-26")
T1 = datetime(2026, 10, 1, 8)
T2 = datetime(2026, 10, 2, 8)
T3 = datetime(2026, 10, 3, 8)


def version(value, at=T1, path="a", digest=None, period="2026-09-26T00", kind="D", who="US48"):
    """One history row."""
    return (period, who, kind, value, "megawatthours", path, at, digest or f"h-{path}")


def history(spark, versions):
    return spark.createDataFrame(versions, HISTORY_SCHEMA)


def record(period, kind, value, who="US48", **other):
    fields = {
        "period": period,
        "respondent": who,
        "respondent-name": "United States Lower 48",
        "type": kind,
        "type-name": "Demand" if kind == "D" else "Day-ahead demand forecast",
        "value": value,
        "value-units": "megawatthours",
    }
    return {**fields, **other}


def day_of_records(day: date, bump: int = 0, who="US48") -> list[dict]:
    """48 records; ``bump`` revises the first hour's actual value."""
    out = []
    for hour in range(24):
        actual = 400_000 + 1_000 * hour + day.day + (bump if hour == 0 else 0)
        out.append(record(f"{day}T{hour:02d}", "D", str(actual), who))
        out.append(record(f"{day}T{hour:02d}", "DF", str(398_000 + 1_100 * hour), who))
    return out


def records_df(spark, records: list[dict], day: date | None = None):
    """Records as a DataFrame with their declared day."""
    schema = T.StructType([*RECORD_SCHEMA.fields, T.StructField("date", T.DateType())])
    names = RECORD_SCHEMA.names
    data = [
        (*[r[n] for n in names], day or date.fromisoformat(r["period"][:10])) for r in records
    ]
    return spark.createDataFrame(data, schema)


def write_file(root: Path, day: date, records, mtime: datetime, name: str | None = None,
               total: str | None = None, raw: str | None = None, folder: str = "") -> Path:
    """A file in the one-file-per-day layout, with its modification time set."""
    where = root / f"respondent=US48/year={day:%Y}/month={day:%m}/day={day:%d}" / folder
    where.mkdir(parents=True, exist_ok=True)
    path = where / (name or f"eia_us48_{day}.json")
    payload = {"response": {"data": records, "total": total or str(len(records or []))}}
    path.write_text(raw if raw is not None else json.dumps(payload, indent=2))
    os.utime(path, (mtime.timestamp(), mtime.timestamp()))
    return path


def days_from(first: date, n: int) -> list[date]:
    return [first + timedelta(days=i) for i in range(n)]
