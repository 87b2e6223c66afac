from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows
from series import CONTRACT, T1, T2, day_of_records, days_from, history, version

from loadledger.contract import DAILY_SCHEMA, HOURLY_SCHEMA
from loadledger.operators import daily, hourly, merge
from loadledger.operators.versions import latest_per_key
from test_versions import random_versions

PUBLISHED = datetime(2026, 10, 4, 1, 21, 57)


def hour(period="2026-09-26T00", actual=539672.0, forecast=533334.0, at=PUBLISHED, who="US48"):
    ts = datetime.strptime(period, "%Y-%m-%dT%H")
    error = None if None in (actual, forecast) else actual - forecast
    size = None if error is None else abs(error)
    return (period, ts, ts.date(), who, actual, forecast, error, size, at)


def hours_df(spark, data):
    return spark.createDataFrame(data, HOURLY_SCHEMA)


def test_pivot_golden_hour(spark):
    stored = [version(539672.0, T1), version(533334.0, PUBLISHED, kind="DF")]
    found = hourly.pivot_hourly(history(spark, stored), CONTRACT).collect()
    assert [tuple(r) for r in found] == [hour()]


def test_pivot_keeps_an_hour_with_one_type(spark):
    found = hourly.pivot_hourly(history(spark, [version(5.0, T1)]), CONTRACT)
    assert [tuple(r) for r in found.collect()] == [hour(actual=5.0, forecast=None, at=T1)]
    assert hourly.paired_hours(found).count() == 0


def test_newest_hourly_equals_pivot_of_latest(spark):
    stored = history(spark, random_versions(5, 300)).repartition(5)
    expected = rows(hourly.pivot_hourly(latest_per_key(stored), CONTRACT))
    assert rows(hourly.newest_hourly(stored, CONTRACT)) == expected


def test_merge_hourly_cases(spark):
    target = [hour("2026-09-26T00"), hour("2026-09-26T01"), hour("2026-09-26T02"), hour("2026-09-26T03")]
    source = [hour("2026-09-26T00"), hour("2026-09-26T01", actual=1.0), hour("2026-09-26T02", at=T2),
              hour("2026-09-26T04")]
    merged = merge.merge_hourly(hours_df(spark, target), hours_df(spark, source))
    found = {r["period"][-2:]: r for r in merged.collect()}
    assert {k: r["action"] for k, r in found.items()} == {
        "00": "unchanged", "01": "updated", "02": "updated", "03": "kept", "04": "inserted"}
    assert tuple(found["01"])[:-1] == hour("2026-09-26T01", actual=1.0)
    assert found["02"]["source_modified_at"] == T2
    again = merge.merge_hourly(merged.drop("action"), hours_df(spark, source))
    assert {r["action"] for r in again.collect()} == {"unchanged", "kept"}


def test_null_safe_change_detection(spark):
    with_null = [hour(forecast=None)]
    same = merge.merge_hourly(hours_df(spark, with_null), hours_df(spark, with_null)).first()
    assert same["action"] == "unchanged"
    filled = merge.merge_hourly(hours_df(spark, with_null), hours_df(spark, [hour()])).first()
    assert (filled["action"], filled["forecast_demand_mwh"]) == ("updated", 533334.0)


def full_days(spark, first=date(2026, 9, 26), n=10):
    data = []
    for day in days_from(first, n):
        values = {(r["period"], r["type"]): float(r["value"]) for r in day_of_records(day)}
        data += [hour(p, v, values[(p, "DF")], T1) for (p, kind), v in values.items() if kind == "D"]
    return data, hours_df(spark, data)


def brute_day(data, day):
    mine = [h for h in data if h[2] == day]
    actual = [h[4] for h in mine]
    return (day, "US48", len(mine), sum(actual) / len(mine), max(actual), sum(actual),
            sum(h[7] for h in mine) / len(mine), max(h[8] for h in mine))


def test_daily_against_brute_force(spark):
    data, df = full_days(spark, n=3)
    expected = sorted((brute_day(data, d) for d in days_from(date(2026, 9, 26), 3)), key=repr)
    assert rows(daily.daily_kpi(df)) == expected
    flags = daily.with_completeness(daily.daily_kpi(df.filter("period <> '2026-09-27T05'")), CONTRACT)
    assert {r["date"].day: r["is_complete"] for r in flags.collect()} == {26: True, 27: False, 28: True}


def test_daily_sum_does_not_depend_on_row_order(spark):
    data = [hour(f"2026-09-26T{h:02d}", 0.1 * (h + 1), 0.3) for h in range(24)]
    totals = {
        tuple(daily.daily_kpi(hours_df(spark, data).repartition(n)).first()) for n in (1, 3, 7)
    }
    assert len(totals) == 1


def test_merge_daily_cases(spark):
    def day(d, total=1.0):
        return (date(2026, 9, d), "US48", 24, 1.0, 1.0, total, 1.0, T1)

    target = spark.createDataFrame([day(26), day(27), day(28)], DAILY_SCHEMA)
    source = spark.createDataFrame([day(26), day(27, 2.0), day(29)], DAILY_SCHEMA)
    merged = merge.merge_daily(target, source)
    found = {r["date"].day: (r["action"], r["total_daily_energy_mwh"]) for r in merged.collect()}
    assert found == {26: ("unchanged", 1.0), 27: ("updated", 2.0), 28: ("kept", 1.0), 29: ("inserted", 1.0)}


def test_trailing_against_brute_force(spark):
    data, df = full_days(spark)
    found = {r["window_days"]: r for r in daily.trailing_kpi(df, CONTRACT).collect()}
    for n in (3, 7, 10):
        last = days_from(date(2026, 9, 26), 10)[-n:]
        mine = [h for h in data if h[2] in last]
        energy, missed = sum(h[4] for h in mine), sum(h[7] for h in mine)
        row = found[n]
        assert (row["hour_count"], row["is_covered"]) == (n * 24, True)
        assert (row["first_date"], row["last_date"]) == (last[0], last[-1])
        assert (row["total_energy_mwh"], row["peak_demand_mwh"]) == (energy, max(h[4] for h in mine))
        assert row["mae_mwh"] == pytest.approx(missed / len(mine), abs=1e-9)
        assert row["accuracy_pct"] == pytest.approx(100 * (1 - missed / energy), abs=1e-9)


def test_trailing_with_a_gap_is_not_covered(spark):
    _, df = full_days(spark, n=4)
    found = daily.trailing_kpi(df.filter("period <> '2026-09-29T07'"), CONTRACT)
    assert {r["window_days"]: r["is_covered"] for r in found.collect()} == {3: False, 7: False, 10: False}


def test_weekend_share_and_latest_dates(spark):
    data, df = full_days(spark)
    weekend = sum(h[4] for h in data if h[2].weekday() >= 5)
    total = sum(h[4] for h in data)
    row = daily.weekend_share(daily.daily_kpi(df)).first()
    assert (row["weekend_energy_mwh"], row["total_energy_mwh"]) == (weekend, total)
    assert row["weekend_share"] == weekend / total
    dates = [r["date"] for r in daily.latest_dates(daily.daily_kpi(df), 3).collect()]
    assert dates == [date(2026, 10, 5), date(2026, 10, 4), date(2026, 10, 3)]
