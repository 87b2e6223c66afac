from __future__ import annotations

import random
from datetime import datetime, timedelta

from conftest import rows
from series import T1, T2, T3, history, version

from loadledger.operators import validity

ASKED = "period string, respondent string, type string, as_of timestamp, tag string"


def ask(spark, asked):
    return spark.createDataFrame(
        [(p, "US48", "D", at, tag) for p, at, tag in asked], ASKED
    )


def answers(df):
    return {(r["period"], r["tag"]): r["value"] for r in df.collect()}


P = "2026-09-26T00"


def test_intervals_end_where_the_next_begins(spark):
    held = history(spark, [version(1.0, T1, "a"), version(3.0, T3, "c"), version(2.0, T2, "b"), version(9.0, T2, "bb")])
    found = validity.validity_intervals(held).select("value", "valid_from", "valid_to")
    assert rows(found) == rows(
        spark.createDataFrame(
            [(1.0, T1, T2), (2.0, T2, T2), (9.0, T2, T3), (3.0, T3, None)],
            "value double, valid_from timestamp, valid_to timestamp",
        )
    )


def test_borders_ties_and_unknown(spark):
    held = history(spark, [version(1.0, T1, "a"), version(2.0, T2, "b"), version(9.0, T2, "bb"), version(3.0, T3, "c")])
    second = timedelta(seconds=1)
    asked = ask(spark, [
        (P, T1 - second, "before"), (P, T1, "at first"), (P, T2 - second, "between"), (P, T2, "tie"),
        (P, T3 + timedelta(days=900), "long after"), ("2026-09-26T01", T3, "no such key"), (P, None, "no time"),
        (None, T3, "no key"), (P, T2, "tie"),
    ])
    found = validity.as_of(held, asked)
    assert found.count() == 9
    assert answers(found) == {
        (P, "before"): None, (P, "at first"): 1.0, (P, "between"): 1.0, (P, "tie"): 9.0,
        (P, "long after"): 3.0, ("2026-09-26T01", "no such key"): None, (P, "no time"): None, (None, "no key"): None,
    }
    assert validity.as_of(held.limit(0), asked).filter("value IS NOT NULL").count() == 0
    assert validity.as_of(held, asked.limit(0)).count() == 0


def test_a_busy_key_equals_a_plain_search(spark):
    rng = random.Random(5)
    start = datetime(2026, 1, 1)
    times = [start + timedelta(minutes=rng.randrange(60 * 24 * 30)) for _ in range(600)]
    held = [version(float(n), t, f"p{n:04d}") for n, t in enumerate(times)]
    asked = [(P, start + timedelta(minutes=rng.randrange(60 * 24 * 40)), f"q{n}") for n in range(500)]
    found = answers(validity.as_of(history(spark, held), ask(spark, asked), seconds=3600 * 7))
    for period, at, tag in asked:
        before = [(t, f"p{n:04d}", float(n)) for n, t in enumerate(times) if t <= at]
        assert found[period, tag] == (max(before)[2] if before else None)


def test_no_range_join(spark):
    held, asked = history(spark, [version(1.0)]), ask(spark, [(P, T2, "x")])
    text = validity.as_of(held, asked)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Cartesian" not in text
