"""Whole runs: volumes, idempotency, incremental against rebuild, recovery, stream against batch."""

from __future__ import annotations

import os
import random
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import rows
from series import CONTRACT, T1, T2, T3, day_of_records, days_from, records_df, write_file

from loadledger import session
from loadledger.operators import quality
from loadledger.plans import refresh
from loadledger.plans.landing import deliver_days
from loadledger.plans.rebuild import daily_from_history, hourly_from_history
from loadledger.sources import landing, tables
from loadledger.operators.versions import latest_per_key
from loadledger.streaming.bronze import stream_bronze

FIRST = date(2026, 9, 26)


def land_first(root):
    """Four complete days."""
    for day in days_from(FIRST, 4):
        write_file(root, day, day_of_records(day), T1)


def land_revisions(root):
    """Two revisions of the first day; the second one counts."""
    for bump, at, digit in ((5, T2, "a"), (7, T3, "b")):
        name = f"eia_us48_{FIRST}_revision_{digit * 64}.json"
        write_file(root, FIRST, day_of_records(FIRST, bump), at, name, folder="revisions")


def contents(spark, root):
    return {layer: rows(tables.published(spark, root, layer)) for layer in tables.LAYERS}


def volumes(spark, root):
    return {layer: len(found) for layer, found in contents(spark, root).items()}


def outcome(stats):
    return {(r["layer"], r["action"]): r["row_count"] for r in stats.collect()}


def test_run_volumes_and_rerun(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    assert volumes(spark, root) == {"history": 192, "latest": 192, "hourly": 96, "daily": 4}
    land_revisions(zone)
    stats = outcome(refresh.run_pipeline(spark, str(zone), root, CONTRACT))
    # six payloads of 48 records
    assert volumes(spark, root) == {"history": 288, "latest": 192, "hourly": 96, "daily": 4}
    assert stats[("history", "inserted")] == 96
    assert (stats[("latest", "updated")], stats[("hourly", "updated")], stats[("daily", "updated")]) == (48, 24, 1)
    day = tables.published(spark, root, "daily").filter("date = DATE'2026-09-26'").first()
    actual = [float(r["value"]) for r in day_of_records(FIRST, 7) if r["type"] == "D"]
    assert (day["hour_count"], day["total_daily_energy_mwh"], day["peak_demand_mwh"]) == (24, sum(actual), max(actual))
    assert day["source_modified_at"] == T3

    before = contents(spark, root)
    stats = outcome(refresh.run_pipeline(spark, str(zone), root, CONTRACT))
    assert contents(spark, root) == before
    assert not [key for key in stats if key[1] in ("inserted", "updated")]

    # incremental equals a rebuild from all files
    history = landing.read_records(spark, str(zone), CONTRACT)
    assert before["latest"] == rows(latest_per_key(history))
    assert before["hourly"] == rows(hourly_from_history(history, CONTRACT))
    assert before["daily"] == rows(daily_from_history(history, CONTRACT))


def test_stored_lookup_prunes_partitions(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    found = tables.find(spark, root, "hourly", period="2026-09-27T03", respondent="US48")
    assert [r["actual_demand_mwh"] for r in found.collect()] == [403_027.0]
    assert len(found.inputFiles()) == 1
    assert tables.find(spark, root, "hourly", period="2030-01-01T00", respondent="US48").count() == 0
    assert tables.find(spark, root, "daily", date=date(2026, 9, 28)).count() == 1


def test_date_range_run(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    later = landing.between(date(2026, 9, 28), date(2026, 9, 30))
    refresh.run_pipeline(spark, str(zone), root, CONTRACT, dates=later)
    assert volumes(spark, root) == {"history": 96, "latest": 96, "hourly": 48, "daily": 2}


def equal_to_rebuild(spark, zone, root):
    """Latest is what history makes it, and all layers are those of a rebuild."""
    found = contents(spark, root)
    history = tables.published(spark, root, "history")
    assert found["latest"] == rows(latest_per_key(history))
    assert found["hourly"] == rows(hourly_from_history(history, CONTRACT))
    assert found["daily"] == rows(daily_from_history(history, CONTRACT))
    read = landing.read_records(spark, str(zone), CONTRACT).drop("source_modified_at")
    assert rows(history.drop("source_modified_at")) == rows(read)


# Every file operation of a run, in order; a run dies just before one of them.
STEPS = ["latest", "hourly", "daily", "history", "commit"]


@pytest.mark.parametrize("dies_at", STEPS)
def test_a_run_that_dies_is_completed_by_the_next(spark, tmp_path, monkeypatch, dies_at):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    before = contents(spark, root)
    land_revisions(zone)
    with monkeypatch.context() as patch:
        write_run = tables.write_run

        def dying_write(df, where, layer, *rest):
            if layer == dies_at:
                raise OSError("disk gone")
            return write_run(df, where, layer, *rest)

        def dying(*_):
            raise OSError("disk gone")

        patch.setattr(tables, "write_run", dying_write)
        # nor does the dying run get to remove what it wrote
        patch.setattr(refresh, "remove", lambda *_: None)
        if dies_at == "commit":
            patch.setattr(tables, dies_at, dying)
        with pytest.raises(OSError, match="disk gone"):
            refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    assert contents(spark, root) == before
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    equal_to_rebuild(spark, zone, root)
    tables.clean_up(spark, root, timedelta(0))
    equal_to_rebuild(spark, zone, root)
    # what the dead run wrote is gone, and so is what the last one superseded
    assert len(list(Path(root).glob("latest/run=*/date=*"))) == 4
    runs = {path.name for path in Path(root).glob("*/run=*")}
    assert len(runs) == 2


def test_a_held_result_survives_the_next_run(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    held = {layer: tables.published(spark, root, layer) for layer in tables.LAYERS}
    tables.register_tables(spark, root, "held_tables")
    before = contents(spark, root)
    land_revisions(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    assert {layer: rows(df) for layer, df in held.items()} == before
    named = {layer: spark.table(f"held_tables.{layer}") for layer in tables.LAYERS}
    assert {layer: rows(df.select(*tables.LAYERS[layer].names)) for layer, df in named.items()} == before
    # an age keeps what was superseded a moment ago, and only that call removes it
    tables.clean_up(spark, root, timedelta(hours=1))
    assert rows(held["daily"]) == before["daily"]
    after = contents(spark, root)
    tables.clean_up(spark, root, timedelta(0))
    assert contents(spark, root) == after != before


def test_staged_folders_go_when_asked_for(spark):
    held = session.stage(spark.range(3).toDF("n"), "held")
    folder = Path(held.inputFiles()[0].removeprefix("file:")).parent
    session.clear_staged(spark, timedelta(hours=1))
    assert held.count() == 3 and folder.exists()
    other = folder.with_name("held-long-ago")
    other.mkdir()
    os.utime(other, (0, 0))
    session.clear_staged(spark, timedelta(hours=1))
    assert folder.exists() and not other.exists()


def test_no_copy_outlives_its_run(spark, tmp_path):
    zone, root = tmp_path / "zone", tmp_path / "layers"
    shared = Path(spark.sparkContext.getConf().get("spark.checkpoint.dir")) / "loadledger"
    before = set(shared.glob("*")) if shared.exists() else set()
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), str(root), CONTRACT)
    land_revisions(zone)
    refresh.run_pipeline(spark, str(zone), str(root), CONTRACT)
    assert set(shared.glob("*")) == before
    tables.clean_up(spark, str(root), timedelta(0))
    # one folder per date, and one more for the revised date's history
    assert len(list(root.glob("latest/run=*/date=*"))) == 4
    assert len(list(root.glob("daily/run=*/date=*"))) == 4
    assert len(list(root.glob("history/run=*/date=*"))) == 5


def touch(path, at):
    os.utime(path, (at.timestamp(), at.timestamp()))


def test_a_file_whose_time_moves_reverts_nothing(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    land_revisions(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    before = contents(spark, root)
    rng = random.Random(3)
    files = sorted(zone.rglob("*.json"))
    for n in range(3):
        for path in rng.sample(files, rng.randint(1, len(files))):
            touch(path, T3 + timedelta(days=n + 1))
        refresh.run_pipeline(spark, str(zone), root, CONTRACT)
        assert contents(spark, root) == before
        history = tables.published(spark, root, "history")
        assert before["latest"] == rows(latest_per_key(history))


def test_a_run_without_news_opens_no_file(spark, tmp_path, monkeypatch):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    first = outcome(refresh.run_pipeline(spark, str(zone), root, CONTRACT))
    assert (first[("files", "accepted")], first[("files", "rejected")], first[("files", "read")]) == (4, 0, 4)
    write_file(zone, FIRST, day_of_records(FIRST), T1, "notes.txt")

    def opened(*_):
        raise AssertionError("a file is decoded")

    with monkeypatch.context() as patch:
        patch.setattr(refresh, "decode_payload", opened)
        again = outcome(refresh.run_pipeline(spark, str(zone), root, CONTRACT))
    assert again == {("files", "accepted"): 4, ("files", "rejected"): 1, ("files", "read"): 0}
    # an older file cannot be read any more, and no run notices
    old = next(zone.rglob("*2026-09-27.json"))
    at = T1.timestamp()
    old.write_text("{not json")
    os.utime(old, (at, at))
    land_revisions(zone)
    assert outcome(refresh.run_pipeline(spark, str(zone), root, CONTRACT))[("files", "read")] == 2


def test_declared_total_is_a_gate(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    write_file(zone, FIRST, day_of_records(FIRST), T1, total="96")
    with pytest.raises(quality.QualityError, match="declared total: 48"):
        refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    assert volumes(spark, root) == dict.fromkeys(tables.LAYERS, 0)


def test_observed_order_end_to_end(spark, tmp_path):
    """A, B, A, B by download time; file times say the opposite."""
    contract = replace(CONTRACT, by_observation=True)
    zone, streamed, root = tmp_path / "zone", str(tmp_path / "streamed"), str(tmp_path / "layers")
    a, b = day_of_records(FIRST), day_of_records(FIRST, 5)
    for n, records in enumerate((a, b, a, b)):
        seen = datetime(2026, 10, n + 1, 8)
        df = records_df(spark, records)
        deliver_days(spark, df, str(zone), contract, baseline="latest", seen_at=seen)
        refresh.run_pipeline(spark, str(zone), root, contract)
    for n, path in enumerate(sorted(zone.rglob("*.txt"), key=lambda p: "canonical" not in str(p))):
        touch(path, datetime(2026, 11, 20 - n, 8))
    stream_bronze(spark, str(zone), streamed, str(tmp_path / "checkpoint"), contract).awaitTermination()
    for where in (root, streamed):
        first = tables.find(spark, where, "latest", period="2026-09-26T00", type="D").first()
        assert (first["value"], first["source_modified_at"]) == (400_031.0, datetime(2026, 10, 4, 8))
        assert len(contents(spark, where)["history"]) == 192


def test_gates_leave_the_tables_as_they_were(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    with pytest.raises(quality.QualityError, match="accepted files present"):
        write_file(zone, FIRST, day_of_records(FIRST), T1, "other.json")
        refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    before = contents(spark, root)
    later = date(2026, 9, 30)
    write_file(zone, later, day_of_records(later)[2:], T2)
    with pytest.raises(quality.QualityError, match=r"complete days: 1 violations \(first: 2026-09-30 US48 23\)"):
        refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    write_file(zone, later, day_of_records(later)[1:], T2)
    with pytest.raises(quality.QualityError, match=r"actual and forecast paired: 1 violations \(first: 2026-09-30T00 US48"):
        refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    assert contents(spark, root) == before


def test_repeated_key_in_latest_stops_the_run(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    one = tables.find(spark, root, "latest", period="2026-09-26T00", type="D")
    rest = tables.find(spark, root, "latest", date="2026-09-26")
    tables.publish(tables.with_date(rest.unionByName(one)), root, "latest", "twice")
    land_revisions(zone)
    with pytest.raises(quality.QualityError, match="latest unique: 1"):
        refresh.run_pipeline(spark, str(zone), root, CONTRACT)


def test_stream_equals_batch(spark, tmp_path):
    zone, streamed, batch = tmp_path / "zone", str(tmp_path / "streamed"), str(tmp_path / "batch")
    checkpoint = str(tmp_path / "checkpoint")

    def drain():
        query = stream_bronze(spark, str(zone), streamed, checkpoint, CONTRACT, files_per_batch=3)
        query.awaitTermination()
        assert query.exception() is None

    land_first(zone)
    drain()
    assert volumes(spark, streamed) == {"history": 192, "latest": 192, "hourly": 96, "daily": 4}
    land_revisions(zone)
    drain()
    refresh.run_pipeline(spark, str(zone), batch, CONTRACT)
    assert contents(spark, streamed) == contents(spark, batch)
    drain()
    assert volumes(spark, streamed) == {"history": 288, "latest": 192, "hourly": 96, "daily": 4}


def test_a_late_file_with_an_old_time_is_streamed(spark, tmp_path):
    zone, root, checkpoint = tmp_path / "zone", str(tmp_path / "layers"), str(tmp_path / "checkpoint")
    day = date(2026, 9, 27)
    write_file(zone, FIRST, day_of_records(FIRST), datetime(2026, 11, 1))
    stream_bronze(spark, str(zone), root, checkpoint, CONTRACT).awaitTermination()
    write_file(zone, day, day_of_records(day), datetime(2025, 10, 1))
    stream_bronze(spark, str(zone), root, checkpoint, CONTRACT).awaitTermination()
    assert volumes(spark, root) == {"history": 96, "latest": 96, "hourly": 48, "daily": 2}


def test_tables_are_available_to_sql(spark, tmp_path):
    zone, root = tmp_path / "zone", str(tmp_path / "layers")
    land_first(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    for _ in range(2):
        tables.register_tables(spark, root, "ledger_test")
    assert spark.table("ledger_test.daily").count() == 4
    land_revisions(zone)
    refresh.run_pipeline(spark, str(zone), root, CONTRACT)
    tables.register_tables(spark, root, "ledger_test")
    assert spark.table("ledger_test.latest").count() == 192
    assert spark.table("ledger_test.history").count() == 288
    peak = spark.sql("SELECT max(peak_demand_mwh) AS p FROM ledger_test.daily WHERE date = DATE'2026-09-27'")
    assert peak.first()["p"] == 423_027.0
