from __future__ import annotations

from datetime import date

import pytest
from series import CONTRACT, T1, day_of_records, days_from, history, record, records_df, version
from test_layers import full_days, hour, hours_df

from loadledger.contract import DAILY_SCHEMA, READING_KEY, SeriesContract
from loadledger.operators import daily, quality
from loadledger.plans.refresh import gate_records

DAY = date(2026, 9, 26)


def report(df) -> dict[str, int]:
    return {r["check"]: r["violations"] for r in df.collect()}


def broken(df) -> dict[str, int]:
    return {check: n for check, n in report(df).items() if n}


@pytest.mark.parametrize(
    ("bad", "check"),
    [
        (version(None), "required fields"),
        (version(float("nan")), "required fields"),
        ((None,) * 8, "required fields"),
        (version(1.0, who="XX"), "respondent in domain"),
        (version(1.0, kind="NG"), "type in domain"),
        (("2026-09-26T00", "US48", "D", 1.0, "kWh", "a", T1, "h"), "unit in domain"),
        (version(1.0, period="2026-09-26 00"), "period parses"),
        (version(1.0, path="good"), "key unique within its file"),
    ],
)
def test_record_gate(spark, bad, check):
    good = version(5.0, path="good")
    assert broken(gate_records(history(spark, [good]), CONTRACT)) == {}
    found = gate_records(history(spark, [good, bad]), CONTRACT)
    assert broken(found) == {check: 1}
    with pytest.raises(quality.QualityError, match=f"{check}: 1"):
        quality.enforce(found)


def test_same_key_in_two_files_is_fine(spark):
    df = history(spark, [version(1.0, path="a"), version(1.0, path="b")])
    assert broken(gate_records(df, CONTRACT)) == {}


def test_open_respondent_domain(spark):
    open_domain = SeriesContract(None, "eia_us48", "2026-09-26")
    assert broken(gate_records(history(spark, [version(1.0, who="anyone")]), open_domain)) == {}


def test_first_broken_rule_is_raised(spark):
    df = history(spark, [version(1.0, kind="NG"), version(None, period="2026-09-26T01")])
    with pytest.raises(quality.QualityError, match="required fields"):
        quality.enforce(gate_records(df, CONTRACT))


def test_not_empty(spark):
    none = spark.range(0)
    assert report(quality.not_empty_report(none, "files")) == {"files": 1}
    assert report(quality.not_empty_report(spark.range(3), "files")) == {"files": 0}


def test_latest_hourly_and_daily_gates(spark):
    twice = history(spark, [version(1.0, path="a"), version(1.0, path="b")])
    found = quality.quality_report(twice, quality.latest_rules(CONTRACT), READING_KEY)
    assert broken(found) == {"unique key": 1}
    one_type = hours_df(spark, [hour(), hour("2026-09-26T01", forecast=None), hour()])
    found = quality.quality_report(one_type, quality.hourly_rules(), ("period", "respondent"))
    assert broken(found) == {"actual and forecast paired": 1, "unique key": 1}
    listed = quality.unpaired_hours(one_type).collect()
    assert [tuple(r) for r in listed] == [
        ("2026-09-26T01", "US48", "forecast_demand_mwh,forecast_error_mwh,absolute_error_mwh")]
    _, full = full_days(spark, n=2)
    short = daily.daily_kpi(full.filter("period <> '2026-09-27T05'"))
    found = quality.quality_report(short, quality.daily_rules(CONTRACT), ("date", "respondent"))
    assert broken(found) == {"complete days": 1}
    assert [tuple(r) for r in quality.incomplete_days(short, CONTRACT).collect()] == [
        (date(2026, 9, 27), "US48", 23)]
    null_day = spark.createDataFrame([(DAY, "US48", 24, None, 1.0, 1.0, 1.0, T1)] * 2, DAILY_SCHEMA)
    found = quality.quality_report(null_day, quality.daily_rules(CONTRACT), ("date", "respondent"))
    assert broken(found) == {"required fields": 2, "unique key": 1}


def test_duplicate_keys(spark):
    df = history(spark, [version(1.0), version(2.0), version(3.0, kind="DF")])
    assert [tuple(r) for r in quality.duplicate_keys(df, READING_KEY).collect()] == [
        ("2026-09-26T00", "US48", "D", 2)]


def audit(spark, records):
    row = quality.audit_days(records_df(spark, records, DAY), CONTRACT).first()
    return {k: row[k] for k in ("null_values", "duplicate_keys", "unexpected_keys", "missing_keys")
            if row[k]} | {"valid": row["is_valid"]}


def test_audit_days(spark):
    full = day_of_records(DAY)
    assert audit(spark, full) == {"valid": True}
    assert audit(spark, full[1:]) == {"missing_keys": 1, "valid": False}
    outside = [*full[1:], record("2026-09-27T00", "D", "1")]
    assert audit(spark, outside) == {"missing_keys": 1, "unexpected_keys": 1, "valid": False}
    assert audit(spark, [*full, full[0]]) == {"duplicate_keys": 1, "valid": False}
    null = [{**full[0], "value": None}, *full[1:]]
    assert audit(spark, null) == {"null_values": 1, "valid": False}
    foreign = [*full, record("2026-09-26T00", "NG", "1")]
    assert audit(spark, foreign) == {"unexpected_keys": 1, "valid": False}


def test_grid_and_gaps(spark):
    bounds = spark.createDataFrame([("US48", DAY, date(2026, 9, 28))], "respondent string, first_date date, last_date date")
    days = quality.date_range(bounds)
    assert [r["date"] for r in days.orderBy("date").collect()] == days_from(DAY, 3)
    grid = quality.expected_grid(days, CONTRACT)
    assert grid.count() == 3 * 48
    assert grid.distinct().count() == 3 * 48
    actual = records_df(spark, [r for d in days_from(DAY, 3) for r in day_of_records(d)])
    assert quality.coverage_gaps(actual, grid).count() == 0
    changed = actual.filter("NOT (period = '2026-09-27T03' AND type = 'D')").unionByName(
        records_df(spark, [record("2026-09-30T00", "D", "1")] * 3))
    assert sorted(tuple(r) for r in quality.coverage_gaps(changed, grid).collect()) == [
        ("2026-09-27T03", "US48", "D", "missing"), ("2026-09-30T00", "US48", "D", "unexpected")]


def watched(spark, tmp_path, df, watch, tallies=()):
    from loadledger.sources import tables

    return tables.write_run(df, str(tmp_path), "hourly", "r", watch, tallies)


def test_rules_seen_while_writing_are_those_of_a_report(spark, tmp_path):
    data = [hour(f"2026-09-26T{h:02d}", forecast=None if h % 5 == 0 else 1.0) for h in range(24)]
    df = hours_df(spark, data + data[3:6] + data[3:4]).repartition(5)
    rules, key = quality.hourly_rules(), ("period", "respondent")
    watch = quality.Watch(rules, key, "hourly unique", 11)
    found = watched(spark, tmp_path, df, watch)
    expected = quality.quality_report(df, rules, key, "hourly unique", 11)
    assert watch.findings() == sorted(tuple(r) for r in expected.collect())
    assert watch.findings()[-1] == (12, "hourly unique", 3)
    assert watch.rows() == found.count() == 28 and found.columns == tables_columns()
    with pytest.raises(quality.QualityError, match="paired: 6 violations"):
        quality.enforce_findings(watch.findings())


def tables_columns():
    from loadledger.sources import tables

    return tables.stored_schema("hourly").names


def test_nothing_to_write_breaks_no_rule(spark, tmp_path):
    watch = quality.Watch(quality.hourly_rules(), ("period", "respondent"), tallied="action")
    df = hours_df(spark, []).selectExpr("*", "'kept' AS action")
    found = watched(spark, tmp_path, df, watch, ("kept", "inserted"))
    assert [n for _, _, n in watch.findings()] == [0, 0]
    assert watch.tally() == {"kept": 0, "inserted": 0} and watch.rows() == found.count() == 0


def test_tallies(spark, tmp_path):
    df = hours_df(spark, [hour(f"2026-09-26T{h:02d}") for h in range(9)])
    df = df.selectExpr("*", "CASE WHEN hour(period_ts) < 4 THEN 'kept' ELSE 'updated' END AS action")
    watch = quality.Watch(tallied="action")
    watched(spark, tmp_path, df, watch, ("kept", "inserted", "updated"))
    assert watch.tally() == {"kept": 4, "inserted": 0, "updated": 5}
    assert watch.findings() == []
