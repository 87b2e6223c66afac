from __future__ import annotations

from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import rows
from series import CONTRACT, T1, T2, T3, day_of_records, days_from, history, records_df, version, write_file

from loadledger.operators.versions import latest_per_key
from loadledger.sources import landing, packed, tables
from loadledger.streaming import latest, notices

DAY = date(2026, 9, 26)


def drain(spark, where):
    query = notices.stream_notices(spark, *(str(where / n) for n in ("zone", "told", "layers", "checkpoint")), CONTRACT)
    query.awaitTermination()


def known_to_source(where) -> int:
    """Names that the stream's source remembers."""
    logs = (where / "checkpoint" / "sources" / "0").glob("[0-9]*")
    return sum(len(path.read_text().splitlines()) - 1 for path in logs)


def test_announced_files_of_any_age_are_taken_once(spark, tmp_path):
    zone, told = str(tmp_path / "zone"), str(tmp_path / "told")
    first = records_df(spark, [r for d in days_from(DAY, 3) for r in day_of_records(d)])
    notices.deliver_and_announce(spark, first, zone, told, CONTRACT)
    drain(spark, tmp_path)
    history_ = tables.published(spark, str(tmp_path / "layers"), "history")
    assert history_.count() == 144
    # a file with a time long past, and one that nobody announced
    late = DAY - timedelta(days=40)
    write_file(tmp_path / "zone", late, day_of_records(late), T1 - timedelta(days=4000))
    write_file(tmp_path / "zone", DAY + timedelta(days=9), day_of_records(DAY + timedelta(days=9)), T3)
    files = landing.scan_landing(spark, zone).filter(f"path LIKE '%{late}%'")
    notices.announce(spark, told, files)
    notices.announce(spark, told, files)  # a second time says nothing new
    drain(spark, tmp_path)
    drain(spark, tmp_path)
    history_ = tables.published(spark, str(tmp_path / "layers"), "history")
    assert history_.count() == 192
    assert {str(r[0])[:10] for r in history_.select("period").distinct().collect()} >= {str(late)}
    assert notices.open_notices(spark, told).count() == 4
    # a delivery that died before its notice is told of by the next
    revised = records_df(spark, day_of_records(DAY, 7))
    notices.deliver_days(spark, revised, zone, CONTRACT)
    notices.deliver_and_announce(spark, revised, zone, told, CONTRACT)
    drain(spark, tmp_path)
    assert tables.published(spark, str(tmp_path / "layers"), "history").count() == 240


def test_state_of_the_source_goes_with_deliveries_not_files(spark, tmp_path):
    told = str(tmp_path / "told")
    files = spark.range(100_000).selectExpr(
        "concat('file:/z/respondent=US48/year=2026/month=09/day=26/x', id) AS path",
        "TIMESTAMP '2026-10-01 00:00:00' AS modificationTime",
    )
    (tmp_path / "zone").mkdir()
    notices.announce(spark, told, files)
    drain(spark, tmp_path)
    many = known_to_source(tmp_path)
    notices.announce(spark, told, files.limit(10).selectExpr("concat(path, 'y') AS path", "modificationTime"))
    drain(spark, tmp_path)
    assert known_to_source(tmp_path) == many + 1 <= 3


def test_latest_as_state_after_each_batch_and_restart(spark, tmp_path):
    held, where = [], {n: str(tmp_path / n) for n in ("history", "updates", "checkpoint")}
    batches = [
        [version(1.0, T2, "a"), version(5.0, T1, "b", period="2026-09-26T01")],
        [version(9.0, T1, "c"), version(2.0, T2, "aa"), version(None, T1, "d", kind="DF")],  # late, tied, null
        [version(3.0, T3, "e"), version(3.0, T3, "e"), version(7.0, T1, "f", period="2026-09-26T02")],
    ]
    for n, batch in enumerate(batches):
        history(spark, batch).write.mode("append").parquet(where["history"])
        latest.stream_latest(spark, *where.values()).awaitTermination()
        held += batch
        expected = latest_per_key(history(spark, held))
        assert rows(latest.served_latest(spark, where["updates"])) == rows(expected)
        assert rows(latest.newest_versions(history(spark, held))) == rows(expected)
        folders = list(Path(where["updates"]).glob("batch=*"))
        assert len(folders) == n + 1
    changed = spark.read.parquet(f"{where['updates']}/batch=2")
    assert {r["period"] for r in changed.collect()} == {"2026-09-26T00", "2026-09-26T02"}
    stores = list(Path(where["checkpoint"]).glob("state/0/*/*.zip"))
    assert stores  # kept by the store on disk


def test_packed_files_give_the_same_history(spark, tmp_path):
    zone, where = tmp_path / "zone", str(tmp_path / "packed")
    days = days_from(date(2026, 9, 1), 40)
    for day in days[:30]:
        write_file(zone, day, day_of_records(day), T1)
    packed.pack_zone(spark, str(zone), where, CONTRACT)
    for day in days[30:]:
        write_file(zone, day, day_of_records(day), T2)
    changed = write_file(zone, days[3], day_of_records(days[3], 9), T3)  # overwritten since
    (zone / "respondent=US48/year=2026/month=09/day=05/notes.txt").write_text("none")

    def same():
        files = landing.landing_accept(packed.scan_packed(spark, str(zone), where), CONTRACT)
        found = landing.to_history(landing.explode_records(landing.decode_payload(files)), CONTRACT)
        assert rows(found) == rows(landing.read_records(spark, str(zone), CONTRACT))

    same()
    packed.pack_zone(spark, str(zone), where, CONTRACT)
    packed.pack_zone(spark, str(zone), where, CONTRACT)
    same()
    assert packed.packed_entries(spark, where).count() == 41  # the overwritten file twice
    assert len(list(Path(where).glob("month=*/*.parquet"))) <= 4  # of 40 files
    some = packed.scan_packed(spark, str(zone), where, days[2:6])
    assert some.count() == 5 and changed.name in {Path(r["path"]).name for r in some.collect()}
    # packed files are not opened: with other bytes of the same length and time they still read as packed
    entries = packed.packed_entries(spark, where)
    assert packed.unpacked_files(landing.scan_landing(spark, str(zone)), entries).select("path").collect() != []


def test_a_damaged_entry_is_an_error(spark, tmp_path):
    zone, where = tmp_path / "zone", str(tmp_path / "packed")
    write_file(zone, DAY, day_of_records(DAY), T1)
    packed.pack_zone(spark, str(zone), where, CONTRACT)
    bad = packed.packed_entries(spark, where).selectExpr(
        "path", "modificationTime", "length", "CAST('x' AS BINARY) AS content", "content_hash", "month"
    )
    bad.write.partitionBy("month").parquet(f"{where}2")
    with pytest.raises(Exception, match="differs from its hash"):
        packed.scan_packed(spark, str(zone), f"{where}2").collect()


def test_empty_zone(spark, tmp_path):
    (tmp_path / "zone").mkdir()
    packed.pack_zone(spark, str(tmp_path / "zone"), str(tmp_path / "packed"), CONTRACT)
    assert packed.scan_packed(spark, str(tmp_path / "zone"), str(tmp_path / "packed")).count() == 0
    drain(spark, tmp_path)
    assert tables.published(spark, str(tmp_path / "layers"), "history").count() == 0
