from __future__ import annotations

from datetime import date

import pytest

from pyspark.sql import functions as F

from series import CONTRACT
from loadledger.operators import quality, state

STATE = "respondent string, last_uploaded_hour string"


def of(spark, *hours):
    return spark.createDataFrame([(f"R{i}", h) for i, h in enumerate(hours)], STATE)


@pytest.mark.parametrize(
    ("last", "start", "work"),
    [
        (None, date(2026, 9, 26), True),
        ("2026-09-26T23", date(2026, 9, 26), True),
        ("2026-10-03T23", date(2026, 10, 2), True),
        ("2026-10-09T23", date(2026, 10, 8), False),
    ],
)
def test_processing_range(spark, last, start, work):
    row = state.processing_range(of(spark, last), CONTRACT, F.lit("2026-10-05")).first()
    assert tuple(row) == ("R0", start, date(2026, 10, 5), work)


def test_processing_hours(spark):
    found = state.processing_hours(of(spark, None, "2026-09-26T05", "2026-09-28T10"), CONTRACT)
    assert {r["respondent"]: r["start_hour"] for r in found.collect()} == {
        "R0": "2026-09-26T00", "R1": "2026-09-26T00", "R2": "2026-09-27T11"}


def test_checkpoints_never_move_back(spark):
    previous = of(spark, "2026-09-28T23", "2026-09-28T23", "2026-09-28T23")
    reached = spark.createDataFrame(
        [("R0", "2026-09-27T23"), ("R1", "2026-09-29T23"), ("R9", "2026-09-26T23")], STATE)
    found = {r["respondent"]: r["last_uploaded_hour"] for r in state.next_checkpoint(previous, reached).collect()}
    assert found == {"R0": "2026-09-28T23", "R1": "2026-09-29T23", "R2": "2026-09-28T23", "R9": "2026-09-26T23"}


def test_checkpoints_of_a_batch(spark):
    records = spark.createDataFrame(
        [("A", "2026-09-26T05"), ("A", "2026-09-27T04"), ("B", "2026-09-26T01")], "respondent string, period string")
    assert {tuple(r) for r in state.batch_checkpoint(records).collect()} == {
        ("A", "2026-09-27T04"), ("B", "2026-09-26T01")}
    days = spark.createDataFrame([("A", date(2026, 9, 26)), ("A", date(2026, 9, 27))], "respondent string, date date")
    assert [tuple(r) for r in state.day_checkpoint(days).collect()] == [("A", "2026-09-27T23")]


@pytest.mark.parametrize(
    ("last", "check"),
    [(None, "checkpoint present"), ("", "checkpoint present"), ("yesterday", "checkpoint parses"),
     ("2026-09-26T22", "checkpoint ends a day"), ("2026-09-26T23", None)],
)
def test_checkpoint_rules(spark, last, check):
    report = quality.quality_report(of(spark, last), quality.checkpoint_rules())
    found = [r["check"] for r in report.collect() if r["violations"]]
    assert found == ([check] if check else [])
