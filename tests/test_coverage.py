from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import rows
from series import CONTRACT, days_from

from loadledger.contract import SeriesContract
from loadledger.operators import coverage, quality

DAY = date(2026, 9, 26)
RECORD = "period string, respondent string, type string"


def frame(spark, keys):
    return spark.createDataFrame(keys, RECORD)


def expected(spark, days, who=("US48",)):
    return spark.createDataFrame([(d, w) for d in days for w in who], "date date, respondent string")


def keys_of(days, who="US48"):
    return [(f"{d}T{h:02d}", who, t) for d in days for h in range(24) for t in ("D", "DF")]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bitmap_equals_the_grid(spark):
    rng = random.Random(4)
    days = days_from(DAY, 5)
    held = [k for k in keys_of(days) if rng.random() < 0.8 and k[0][:10] != "2026-09-28"]
    held += rng.choices(held, k=50)  # repeated readings
    held += [("2026-09-26T00", "US48", "NG"), ("2026-09-26 00", "US48", "D"), (None, "US48", "D")]
    held += [("2026-09-26T05", None, "D"), ("2026-09-26T05", "US48", None), ("2027-01-01T03", "US48", "DF")]
    held += [("2026-09-26T07", "XX", "D"), ("2026-09-26T00", "US48", "NG")]
    actual, wanted = frame(spark, held), expected(spark, days)
    found = coverage.coverage_bitmap(actual, wanted, CONTRACT)
    assert rows(found) == rows(quality.coverage_gaps(actual, quality.expected_grid(wanted, CONTRACT)))


def test_no_grid_in_the_plan(spark):
    actual, wanted = frame(spark, keys_of([DAY])), expected(spark, [DAY])
    assert "Generate explode" in plan(quality.expected_grid(wanted, CONTRACT))
    text = plan(coverage.missing_masks(actual, wanted, CONTRACT))
    assert "Generate" not in text and "Expand" not in text
    # rows come out of masks only once those that lack nothing are gone
    text = plan(coverage.coverage_bitmap(actual, wanted, CONTRACT))
    assert text.index("Generate") < text.index("FullOuter")


def test_masks_and_counts(spark):
    held = [k for k in keys_of([DAY]) if k[0].endswith(("T00", "T23"))] + [("2026-09-26T05", "US48", "D")]
    day = coverage.day_masks(frame(spark, held), CONTRACT).first()
    assert (day["readings"], day["missing"]) == (5, 43)
    assert day["mask"] == sum(1 << n for n in (0, 5, 23, 24, 47))
    assert coverage.day_masks(frame(spark, []), CONTRACT).count() == 0


def test_a_day_that_no_mask_holds_is_refused(spark):
    wide = SeriesContract(("US48",), "x", "2026-09-26", hours_per_day=40)
    with pytest.raises(ValueError, match="80 readings"):
        coverage.day_masks(frame(spark, []), wide)


def test_runs_cross_midnight_and_end_at_days_that_are_not_expected(spark):
    days = days_from(DAY, 6)
    lost = {f"{DAY}T22", f"{DAY}T23", f"{days[1]}T00", f"{days[1]}T05", f"{days[3]}T23"}
    held = [k for k in keys_of([d for d in days if d != days[2]]) if not (k[0] in lost and k[2] == "D")]
    wanted = expected(spark, [d for d in days if d != days[4]])
    found = coverage.gap_runs(frame(spark, held), wanted, CONTRACT)
    assert rows(found) == rows(
        spark.createDataFrame(
            [
                ("US48", "D", f"{DAY}T22", f"{days[1]}T00", 3),
                ("US48", "D", f"{days[1]}T05", f"{days[1]}T05", 1),
                ("US48", "D", f"{days[2]}T00", f"{days[2]}T23", 24),
                ("US48", "DF", f"{days[2]}T00", f"{days[2]}T23", 24),
                ("US48", "D", f"{days[3]}T23", f"{days[3]}T23", 1),
            ],
            found.schema,
        )
    )


def test_runs_equal_a_plain_count(spark):
    rng = random.Random(8)
    days, who = days_from(DAY, 20), ("AA", "BB")
    held = [k for w in who for k in keys_of(days, w) if rng.random() < 0.5]
    found = coverage.gap_runs(frame(spark, held), expected(spark, days, who), CONTRACT)
    brute, present = [], set(held)
    for w in who:
        for kind in ("D", "DF"):
            run = []
            for d in [*days, DAY + timedelta(days=99)]:
                for h in range(24):
                    period = f"{d}T{h:02d}"
                    if d in days and (period, w, kind) not in present:
                        run.append(period)
                    elif run:
                        brute.append((w, kind, run[0], run[-1], len(run)))
                        run = []
    assert rows(found) == sorted(brute, key=repr)
