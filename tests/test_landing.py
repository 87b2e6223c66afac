from __future__ import annotations

import hashlib
import json
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from series import CONTRACT, T1, T2, T3, day_of_records, days_from, record, records_df, write_file

from loadledger.operators import days, quality, versions
from loadledger.plans.landing import deliver_days, ingest_days
from loadledger.sources import landing
from loadledger.sources.checkpoints import read_checkpoint

DAY = date(2026, 9, 26)


def decoded(spark, root):
    files = landing.landing_accept(landing.scan_landing(spark, str(root)), CONTRACT)
    return landing.decode_payload(files)


def canonical_digest(records):
    """The digest as the JSON module would give it."""
    ordered = sorted(records, key=lambda r: (r["period"], r["respondent"], r["type"]))
    text = json.dumps(ordered, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()


def test_reads_files_of_the_plain_layout(spark, tmp_path):
    path = write_file(tmp_path, DAY, day_of_records(DAY), T1)
    name = "eia_us48_2026-09-26_revision_" + "a" * 64 + ".json"
    write_file(tmp_path, DAY, day_of_records(DAY, 7), T2, name, folder="revisions")
    write_file(tmp_path, DAY, day_of_records(DAY, 9), T3, "eia_us48_2026-09-26.json.tmp")
    found = landing.to_history(landing.explode_records(decoded(spark, tmp_path)), CONTRACT)
    assert found.count() == 96
    assert {r["content_hash"] for r in found.filter("source_path LIKE '%26.json'").collect()} == {
        hashlib.sha256(path.read_bytes()).hexdigest()}
    assert {r["source_modified_at"] for r in found.select("source_modified_at").collect()} == {T1, T2}
    latest = versions.latest_per_key(found).filter("period = '2026-09-26T00' AND type = 'D'")
    assert [r["value"] for r in latest.collect()] == [400_033.0]


def test_bad_files_show_up_as_null_rows(spark, tmp_path):
    write_file(tmp_path, DAY, None, T1, raw="{not json")
    write_file(tmp_path, date(2026, 9, 27), [], T1)
    write_file(tmp_path, date(2026, 9, 28), [record("2026-09-28T00", "D", "abc")], T1)
    found = landing.to_history(landing.explode_records(decoded(spark, tmp_path)), CONTRACT)
    gate = quality.quality_report(found, quality.record_rules(CONTRACT))
    assert {r["check"]: r["violations"] for r in gate.collect()}["required fields"] == 3


def test_declared_total(spark, tmp_path):
    write_file(tmp_path, DAY, day_of_records(DAY), T1)
    write_file(tmp_path, date(2026, 9, 27), day_of_records(date(2026, 9, 27))[1:], T1, total="48")
    totals = landing.declared_totals(decoded(spark, tmp_path))
    assert {r["date"].day: (r["declared_total"], r["record_count"], r["total_matches"])
            for r in totals.collect()} == {26: (48, 48, True), 27: (48, 47, False)}


def test_date_range_lists_only_its_months(spark, tmp_path):
    far = date(2027, 3, 1)
    for day in [*days_from(DAY, 4), far]:
        write_file(tmp_path, day, day_of_records(day), T1)
    (tmp_path / "respondent=US48/year=2026/month=09/day=28/version=canonical").mkdir()
    wanted = landing.between(date(2026, 9, 27), date(2026, 9, 28))
    files = landing.scan_landing(spark, str(tmp_path), wanted)
    assert {r["path"][-15:] for r in files.collect()} == {"2026-09-27.json", "2026-09-28.json"}
    assert not any("2027" in path for path in files.inputFiles())
    # a span of any length has one form of plan
    long = landing.scan_landing(spark, str(tmp_path), [date(1990, 1, 1), date(2060, 1, 1)])
    assert long.count() == 5
    assert landing.scan_landing(spark, str(tmp_path), [date(2028, 1, 1)]).count() == 0
    assert landing.scan_landing(spark, str(tmp_path), []).count() == 0


def test_only_the_months_of_the_days_are_listed(spark, tmp_path):
    old, new = date(2019, 3, 5), date(2026, 9, 26)
    for day in (old, date(2022, 1, 1), date(2026, 9, 1), new):
        write_file(tmp_path, day, day_of_records(day), T1)
    days_ = spark.createDataFrame([(old,), (new,), (new,), (None,)], "date date")
    files = landing.scan_days(spark, str(tmp_path), days_)
    assert {r["path"][-15:] for r in files.collect()} == {f"{old}.json", f"{new}.json"}
    assert not any("2022" in path for path in files.inputFiles())
    assert landing.scan_days(spark, str(tmp_path), days_.limit(0)).count() == 0
    assert landing.scan_days(spark, str(tmp_path), days_.selectExpr("date + 99999 AS date")).count() == 0


def test_observed_time_is_read(spark, tmp_path):
    body = {"response": {"data": [record("2026-09-26T00", "D", "1")], "total": "1"},
            "ingestion_metadata": {"downloaded_at_utc": "2026-10-01T08:00:00+00:00"}}
    write_file(tmp_path, DAY, None, T2, raw=json.dumps(body))
    assert landing.explode_records(decoded(spark, tmp_path)).first()["observed_at"] == T1


def test_fingerprint_is_the_digest_of_canonical_json(spark):
    records = day_of_records(DAY)
    found = days.day_fingerprint(records_df(spark, list(reversed(records)))).first()
    assert found["fingerprint"] == canonical_digest(records)
    accents = [record("2026-09-26T00", "D", "1", **{"type-name": 'Dé "x" / y'})]
    assert days.day_fingerprint(records_df(spark, accents)).first()["fingerprint"] == canonical_digest(accents)
    nulls = [record("2026-09-26T00", "D", "1", **{"type-name": None})]
    assert days.day_fingerprint(records_df(spark, nulls)).first()["fingerprint"] == canonical_digest(nulls)


def test_repeated_record_fails_the_fingerprint(spark):
    twice = [record("2026-09-26T00", "D", "1"), record("2026-09-26T00", "D", "2")]
    with pytest.raises(Exception, match="duplicate record: 2026-09-26T00 US48 D"):
        days.day_fingerprint(records_df(spark, twice)).collect()


def deliver(spark, root, records, **options):
    judged = deliver_days(spark, records_df(spark, records), str(root), CONTRACT, **options)
    return {r["date"].day: r["status"] for r in judged.collect()}


def landed(spark, root):
    return {(r["date"].day, r["version"], r["record_count"])
            for r in landing.landed_days(decoded(spark, root)).collect()}


def test_delivery(spark, tmp_path):
    root = tmp_path / "zone"
    first, second = DAY, date(2026, 9, 27)
    assert deliver(spark, root, day_of_records(first)) == {26: "NEW"}
    assert deliver(spark, root, day_of_records(first)) == {26: "UNCHANGED"}
    revised = day_of_records(first, 5)
    both = [*revised, *day_of_records(second)]
    assert deliver(spark, root, both) == {26: "REVISION", 27: "NEW"}
    version = "revision_" + canonical_digest(revised)
    expected = {(26, "canonical", 48), (26, version, 48), (27, "canonical", 48)}
    assert landed(spark, root) == expected
    # the same delivery again is recognised, and writes nothing
    files = sorted(p for p in root.rglob("*.txt"))
    assert deliver(spark, root, both) == {26: "REVISION", 27: "UNCHANGED"}
    assert sorted(p for p in root.rglob("*.txt")) == files
    one = next(root.rglob("day=27/version=canonical/*.txt")).read_text()
    payload = json.loads(one)
    assert payload["response"]["total"] == "48"
    assert payload["response"]["data"] == sorted(
        day_of_records(second), key=lambda r: (r["period"], r["respondent"], r["type"]))


def test_metadata_change_is_a_revision(spark, tmp_path):
    root = tmp_path / "zone"
    records = day_of_records(DAY)
    deliver(spark, root, records)
    renamed = [{**records[0], "type-name": "Demand, revised"}, *records[1:]]
    assert deliver(spark, root, renamed) == {26: "REVISION"}


def test_return_to_earlier_values(spark, tmp_path):
    """A, B, A: the canonical baseline calls it unchanged, the latest one a revision."""
    a, b = day_of_records(DAY), day_of_records(DAY, 5)
    root = tmp_path / "canonical"
    assert [deliver(spark, root, r)[26] for r in (a, b, a)] == ["NEW", "REVISION", "UNCHANGED"]
    root = tmp_path / "latest"
    seen = []
    for i, r in enumerate((a, b, a, b)):
        found = deliver(spark, root, r, baseline="latest", seen_at=datetime(2026, 10, i + 1, 8))
        seen.append(found[26])
    assert seen == ["NEW", "REVISION", "REVISION", "REVISION"]
    assert len(landed(spark, root)) == 4
    exploded = landing.explode_records(decoded(spark, root))
    observed = landing.to_history(exploded, replace(CONTRACT, by_observation=True))
    newest = versions.latest_per_key(observed).filter("period = '2026-09-26T00' AND type = 'D'").first()
    assert (newest["value"], newest["source_modified_at"]) == (400_031.0, datetime(2026, 10, 4, 8))
    with pytest.raises(ValueError, match="seen_at"):
        deliver_days(spark, records_df(spark, a), str(root), CONTRACT, baseline="latest")


@pytest.mark.parametrize(
    "records",
    [
        day_of_records(DAY)[1:],
        [*day_of_records(DAY), record("2026-09-26T00", "NG", "1")],
        [{**day_of_records(DAY)[0], "value": None}, *day_of_records(DAY)[1:]],
    ],
    ids=["incomplete", "foreign type", "null"],
)
def test_unfit_days_are_not_landed(spark, tmp_path, records):
    root = tmp_path / "zone"
    with pytest.raises(quality.QualityError, match="1 days are not fit"):
        deliver(spark, root, records)
    assert list(root.rglob("*.txt")) == []


def test_unreadable_canonical_file_is_an_error(spark, tmp_path):
    root, saved = tmp_path / "zone", str(tmp_path / "state")
    write_file(root, DAY, None, T1, raw="{not json")
    files = sorted(root.rglob("*.*"))
    records = records_df(spark, [*day_of_records(DAY), *day_of_records(date(2026, 9, 27))])
    with pytest.raises(quality.QualityError, match="landed files readable: 1 violations .*2026-09-26.json"):
        deliver_days(spark, records, str(root), CONTRACT)
    with pytest.raises(quality.QualityError, match="landed files readable"):
        ingest_days(spark, records, str(root), saved, CONTRACT, "2026-09-27")
    assert read_checkpoint(spark, saved, CONTRACT).count() == 0
    assert sorted(root.rglob("*.*")) == files


def test_tampered_version_is_an_error(spark, tmp_path):
    root = tmp_path / "zone"
    deliver(spark, root, day_of_records(DAY))
    revised = day_of_records(DAY, 5)
    deliver(spark, root, revised)
    path = next(root.rglob("version=revision_*/*.txt"))
    path.write_text(path.read_text().replace('"400031"', '"7"'))
    path.with_name(f".{path.name}.crc").unlink()
    with pytest.raises(quality.QualityError, match="landed versions unchanged: 1 violations .*2026-09-26 US48 revision_"):
        deliver(spark, root, revised)
    # land_days on its own refuses as well, and does not write a known version twice
    with pytest.raises(quality.QualityError, match="landed versions unchanged"):
        landing.land_days(records_df(spark, revised), str(root), CONTRACT)
    fresh = str(tmp_path / "fresh")
    for _ in range(2):
        landing.land_days(records_df(spark, revised), fresh, CONTRACT)
    assert len(list(Path(fresh).rglob("*.txt"))) == 1


def test_foreign_keys_are_refused_before_a_day_is_collected(spark, tmp_path, monkeypatch):
    foreign = [record("2026-09-26T00", f"X{n}", "1") for n in range(500)]

    def collected(*_, **__):
        raise AssertionError("records are collected per day")

    for name in ("loadledger.plans.landing.day_fingerprint", "loadledger.sources.landing.day_fingerprint"):
        monkeypatch.setattr(name, collected)
    with pytest.raises(quality.QualityError, match="1 days are not fit"):
        deliver(spark, tmp_path / "zone", [*day_of_records(DAY), *foreign])


def test_conflicts(spark):
    names = "date date, respondent string, version string, fingerprint string"
    there = spark.createDataFrame([(DAY, "US48", "canonical", "f1"), (DAY, "US48", "revision_x", "f2")], names)
    due = spark.createDataFrame(
        [(DAY, "US48", "canonical", "f1"), (DAY, "US48", "revision_x", "f3"), (DAY, "US48", "revision_y", "f2")], names)
    found = days.landing_conflicts(due, there)
    assert rows(found.select("version", "outcome")) == [
        ("canonical", "skip"), ("revision_x", "conflict"), ("revision_y", "write")]


def test_ingest_with_checkpoint(spark, tmp_path):
    root, saved = str(tmp_path / "zone"), str(tmp_path / "state")

    def run(records, end):
        df = records_df(spark, records)
        judged = ingest_days(spark, df, root, saved, CONTRACT, end)
        state = {r["respondent"]: r["last_uploaded_hour"] for r in read_checkpoint(spark, saved, CONTRACT).collect()}
        return {r["date"].day: r["status"] for r in judged.collect()}, state

    source = [r for d in days_from(DAY, 4) for r in day_of_records(d)]
    assert run(source, "2026-09-28") == ({26: "NEW", 27: "NEW", 28: "NEW"}, {"US48": "2026-09-28T23"})
    # the lookback takes in one day before the last; an older change is not seen
    revised = [r for d in days_from(DAY, 4) for r in day_of_records(d, 5)]
    assert run(revised, "2026-09-29") == (
        {27: "REVISION", 28: "REVISION", 29: "NEW"}, {"US48": "2026-09-29T23"})
    # an earlier end date finds nothing to do and does not move the state back
    assert run(revised, "2026-09-27") == ({}, {"US48": "2026-09-29T23"})
    # a day that is not fit stops the run before anything moves
    later = [*revised, *day_of_records(date(2026, 9, 30))[1:]]
    with pytest.raises(quality.QualityError):
        run(later, "2026-09-30")
    assert read_checkpoint(spark, saved, CONTRACT).first()["last_uploaded_hour"] == "2026-09-29T23"


def test_forms_of_a_checkpoint(spark, tmp_path):
    def saved(name, *lines):
        (tmp_path / name).mkdir()
        (tmp_path / name / "state.json").write_text("\n".join(map(json.dumps, lines)))
        return str(tmp_path / name)

    def hours(path, contract=CONTRACT):
        return {r["respondent"]: r["last_uploaded_hour"] for r in read_checkpoint(spark, path, contract).collect()}

    single = saved("single", {"last_uploaded_hour": "2026-09-28T23", "updated_at_utc": "2026-09-29T01:00:00+00:00"})
    older = saved("older", {"last_successful_hour": "2026-09-27T23"})
    both = saved("both", {"respondent": "US48", "last_uploaded_hour": "2026-09-26T23"}, {"last_uploaded_hour": "2026-09-27T23"})
    assert hours(single) == {"US48": "2026-09-28T23"}
    assert hours(older) == {"US48": "2026-09-27T23"}
    assert hours(both) == {"US48": "2026-09-27T23"}
    several = replace(CONTRACT, respondents=("A", "B"))
    for contract in (several, replace(CONTRACT, respondents=None)):
        with pytest.raises(quality.QualityError, match="checkpoint names its respondent"):
            hours(single, contract)
    # a run goes on from the single value
    source = records_df(spark, [r for d in days_from(DAY, 5) for r in day_of_records(d)])
    judged = ingest_days(spark, source, str(tmp_path / "zone"), single, CONTRACT, "2026-09-30")
    assert sorted(r["date"].day for r in judged.collect()) == [27, 28, 29, 30]
    assert hours(single) == {"US48": "2026-09-30T23"}


def with_origin(df, edition):
    """An eighth field, an object whose keys are out of order."""
    from pyspark.sql import functions as F

    inner = F.struct(F.lit("b").alias("z"), F.lit("a").alias("a"))
    return df.withColumn("origin", F.struct(F.lit("x").alias("unit"), F.lit(edition).alias("edition"), inner.alias("by")))


def test_a_field_beyond_the_declared_ones_makes_a_revision(spark, tmp_path):
    root = str(tmp_path)
    records = records_df(spark, day_of_records(date(2026, 9, 26)) + day_of_records(date(2026, 9, 27)))
    first = deliver_days(spark, with_origin(records, 1), root, CONTRACT)
    assert {r["status"] for r in first.collect()} == {"NEW"}
    text = next(iter(tmp_path.glob("**/day=26/version=canonical/*.txt"))).read_text()
    held = json.loads(text)["response"]["data"][0]
    assert held["origin"] == {"by": {"a": "a", "z": "b"}, "edition": 1, "unit": "x"}
    assert '"origin":{"by":{"a":"a","z":"b"},"edition":1,"unit":"x"},"period"' in text
    again = deliver_days(spark, with_origin(records, 1), root, CONTRACT)
    assert {r["status"] for r in again.collect()} == {"UNCHANGED"}
    mixed = with_origin(records.filter("day(date) = 26"), 1).unionByName(
        with_origin(records.filter("day(date) = 27"), 2)
    )
    found = {r["date"].day: r["status"] for r in deliver_days(spark, mixed, root, CONTRACT).collect()}
    assert found == {26: "UNCHANGED", 27: "REVISION"}
    # the declared fields of both versions are the same, and are read as before
    values = landing.read_records(spark, root, CONTRACT).select("period", "type", "value").distinct()
    assert values.count() == 96


def test_digest_of_a_foreign_file_does_not_depend_on_its_layout(spark, tmp_path):
    records = day_of_records(date(2026, 9, 26))
    for record_ in records:
        record_["origin"] = {"b": [1, {"d": None, "c": 2}], "a": "\u00e9"}
    zones = [tmp_path / name for name in ("plain", "mixed")]
    write_file(zones[0], date(2026, 9, 26), records, T1)
    shuffled = [dict(reversed(r.items())) for r in reversed(records)]
    shuffled[0]["origin"] = dict(reversed(shuffled[0]["origin"].items()))
    write_file(zones[1], date(2026, 9, 26), shuffled, T1)
    digests = set()
    for zone in zones:
        files = landing.landing_accept(landing.scan_landing(spark, str(zone)), CONTRACT)
        digests |= {r["fingerprint"] for r in landing.landed_days(landing.decode_payload(files)).collect()}
    expected = sorted(records, key=lambda r: (r["period"], r["respondent"], r["type"]))
    canonical = json.dumps(expected, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert digests == {hashlib.sha256(canonical.encode()).hexdigest()}
