from __future__ import annotations

import random
from datetime import date

from conftest import rows
from series import CONTRACT, days_from
from test_layers import hour, hours_df

from loadledger.operators import daily, trailing
from loadledger.plans.trailing import read_figures, refresh_trailing, start_trailing

FIRST = date(2026, 9, 1)


def table(spark, values):
    """Hours of {(day, hour, who): (actual, forecast)}."""
    return hours_df(
        spark, [hour(f"{d}T{h:02d}", a, f, who=w) for (d, h, w), (a, f) in sorted(values.items())]
    )


def test_every_delivery_equals_a_fresh_start(spark, tmp_path):
    rng = random.Random(6)
    days, who = days_from(FIRST, 14), ["AA", "BB", "CC"]
    values = {
        (d, h, w): (rng.randrange(100, 200) / 4, rng.randrange(100, 200) / 4)
        for d in days[:9] for h in range(3) for w in who[:2]
    }
    start_trailing(table(spark, values), f"{tmp_path}/0")
    for n in range(1, 6):
        before = dict(values)
        for _ in range(6):  # revise hours, peaks among them
            key = rng.choice(sorted(values))
            values[key] = (rng.randrange(1, 300) / 4, 10.0)
        peak = max(values, key=lambda k: values[k][0])
        values[peak] = (1.0, 2.0)
        if n == 2:  # an hour loses its forecast, a whole day goes, a respondent begins
            values[sorted(values)[0]] = (5.0, None)
            values = {k: v for k, v in values.items() if k[0] != days[4]}
            values |= {(days[1], h, "CC"): (7.5, 7.0) for h in range(2)}
        if n >= 3:  # a new day
            values |= {(days[6 + n], h, "AA"): (rng.randrange(1, 300) / 4, 3.0) for h in range(3)}
        if n == 5:  # one respondent leaves
            values = {k: v for k, v in values.items() if k[2] != "CC"}
        old, new = table(spark, before), table(spark, values)
        found = refresh_trailing(spark, old, new, f"{tmp_path}/{n - 1}", f"{tmp_path}/{n}")
        served = trailing.served_windows(found, CONTRACT)
        assert rows(served) == rows(daily.trailing_kpi(new, CONTRACT).select(*served.columns))
        kept, _ = read_figures(spark, f"{tmp_path}/{n}")
        fresh = trailing.day_figures(new)
        assert rows(kept.select(*fresh.columns)) == rows(fresh)


def test_changes_out_of_reach_touch_no_window(spark):
    values = {(d, 0, w): (1.0, 2.0) for d in days_from(FIRST, 15) for w in ("AA", "BB")}
    days = trailing.day_figures(table(spark, values))
    old = trailing.day_figures(table(spark, {(FIRST, 0, "AA"): (9.0, 2.0)}))
    near = trailing.day_figures(table(spark, {(days_from(FIRST, 15)[7], 0, "BB"): (9.0, 2.0)}))
    touched = trailing.touched_windows(days, old.unionByName(near))
    assert [r[0] for r in touched.collect()] == ["BB"]


def test_only_folders_of_changed_respondents_are_read(spark, tmp_path):
    values = {(d, 0, w): (1.0, 2.0) for d in days_from(FIRST, 12) for w in ("AA", "BB", "CC", "DD")}
    start_trailing(table(spark, values), f"{tmp_path}/0")
    days, windows = read_figures(spark, f"{tmp_path}/0")
    changed = spark.createDataFrame(
        trailing.day_figures(table(spark, {(days_from(FIRST, 12)[11], 0, "BB"): (9.0, 2.0)})).collect(),
        trailing.day_figures(table(spark, values)).schema,
    )
    found = trailing.changed_windows(windows, days, changed)
    assert {r["respondent"] for r in found.collect()} == {"BB"}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text


def test_no_change_is_no_change(spark):
    values = {(d, h, "AA"): (1.0, 2.0) for d in days_from(FIRST, 3) for h in range(3)}
    hours = table(spark, values)
    signed = trailing.hour_changes(hours, hours)
    assert signed.count() == 0
    figures = trailing.day_figures(hours)
    assert trailing.changed_days(figures, signed, hours).count() == 0
