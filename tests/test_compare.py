from __future__ import annotations

from datetime import date

from series import CONTRACT, T2, record, records_df
from test_layers import full_days, hour, hours_df

from loadledger.contract import DAILY_SCHEMA, HOURLY_SCHEMA
from loadledger.operators import compare, daily
from loadledger.session import fresh_dir
from loadledger.sources import snapshots


def test_snapshot_diff(spark):
    def at(h, value="1", **other):
        return record(f"2026-09-26T{h:02d}", "D", value, **other)

    mine = [at(0), at(1), at(2, "5"), at(3, **{"type-name": "Other"}), at(4, None)]
    theirs = [at(1), at(2, "4"), at(3), at(4, None), at(9)]
    diff = compare.snapshot_diff(records_df(spark, mine), records_df(spark, theirs))
    found = {r["period"][-2:]: (r["status"], r["old_value"], r["new_value"], r["changed_fields"])
             for r in diff.collect()}
    assert found == {
        "00": ("missing", None, "1", None),
        "01": ("equal", "1", "1", []),
        "02": ("value_change", "4", "5", ["value"]),
        "03": ("metadata_change", "1", "1", ["type-name"]),
        "04": ("equal", None, None, []),
        "09": ("extra", "1", None, None),
    }
    counts = {r["status"]: r["key_count"] for r in compare.diff_summary(diff).collect()}
    assert counts == {"missing": 1, "equal": 2, "value_change": 1, "metadata_change": 1, "extra": 1}


def test_diff_with_itself_is_empty(spark):
    same = records_df(spark, [record(f"2026-09-26T{h:02d}", "D", str(h)) for h in range(24)])
    assert compare.snapshot_diff(same, same).filter("status <> 'equal'").count() == 0


def outcome(report):
    return {r["check"]: (r["compared"], r["failed"]) for r in report.collect()}


def test_reconcile_equal_datasets(spark):
    _, df = full_days(spark)
    days = daily.daily_kpi(df)
    report = compare.reconcile(df, df, days, days, CONTRACT)
    found = outcome(report)
    assert all(failed == 0 for _, failed in found.values())
    assert report.filter("NOT passed").count() == 0
    # 240 hours with two values, ten days with three figures, two checks for three windows
    assert sum(n for name, (n, _) in found.items() if name in ("hourly actual", "hourly forecast")) == 480
    assert sum(n for name, (n, _) in found.items() if name in ("daily energy", "daily peak", "daily MAE")) == 30
    assert sum(n for name, (n, _) in found.items() if "-day" in name) == 6
    assert [r["ordinal"] for r in report.orderBy("ordinal").collect()] == list(range(1, 18))


def test_reconcile_finds_differences(spark):
    data, df = full_days(spark)
    days = daily.daily_kpi(df)
    changed = [list(h) for h in data]
    changed[5][4] += 0.005  # within tolerance
    changed[6][4] += 1.0
    changed[7][5] -= 1.0
    changed.append(list(hour("2026-12-01T00")))
    changed.append(list(data[0]))
    other = hours_df(spark, [tuple(h) for h in changed])
    wrong_day = spark.createDataFrame(
        [(r["date"], r["respondent"], r["hour_count"], r["avg_hourly_demand_mwh"], r["peak_demand_mwh"],
          r["total_daily_energy_mwh"] + (10.0 if r["date"] == date(2026, 10, 5) else 0.0), r["mae_mwh"], T2)
         for r in days.collect()], DAILY_SCHEMA)
    found = outcome(compare.reconcile(df, other, days, wrong_day, CONTRACT))
    failed = {name for name, (_, n) in found.items() if n}
    assert failed == {"hourly row count", "hourly keys unique", "hourly keys match", "hourly actual",
                      "hourly forecast", "daily energy", "3-day total energy", "7-day total energy",
                      "10-day total energy"}
    assert found["hourly actual"] == (240, 1)


def test_snapshot_round_trip(spark):
    df = hours_df(spark, [hour(), hour("2026-09-26T01", actual=0.1, forecast=None, at=T2)])
    path = fresh_dir(spark, "snapshot")
    snapshots.export_snapshot(df, path)
    back = snapshots.read_snapshot(spark, path, HOURLY_SCHEMA)
    assert back.schema.names == HOURLY_SCHEMA.names
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


def test_snapshot_with_bom_and_whole_seconds(spark, tmp_path):
    head = ",".join(DAILY_SCHEMA.names)
    line = "2026-09-26,US48,24,458994.3333333333,539672.0,1.1015864E7,3130.375,2026-10-04 01:21:57"
    (tmp_path / "daily.csv").write_bytes(b"\xef\xbb\xbf" + f"{head}\n{line}\n".encode())
    row = snapshots.read_snapshot(spark, str(tmp_path / "daily.csv"), DAILY_SCHEMA).first()
    assert (row["date"], row["total_daily_energy_mwh"]) == (date(2026, 9, 26), 11015864.0)
    assert row["avg_hourly_demand_mwh"] == 11015864 / 24
    assert str(row["source_modified_at"]) == "2026-10-04 01:21:57"
