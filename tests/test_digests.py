from __future__ import annotations

from datetime import date

import pytest
from conftest import rows
from series import day_of_records, days_from, record, records_df

from loadledger.operators import compare, digests
from loadledger.plans import snapshots

FIRST = date(2026, 9, 1)


def days(spark, n, bumps=(), extra=()):
    found = [r for d in days_from(FIRST, n) for r in day_of_records(d, 5 if d in bumps else 0)]
    return records_df(spark, found + list(extra))


def stored(spark, tmp_path, mine, theirs):
    snapshots.write_snapshot(mine, f"{tmp_path}/mine")
    snapshots.write_snapshot(theirs, f"{tmp_path}/theirs")
    return f"{tmp_path}/mine", f"{tmp_path}/theirs"


def same(spark, tmp_path, mine, theirs):
    paths = stored(spark, tmp_path, mine, theirs)
    whole = compare.snapshot_diff(mine, theirs)
    found = snapshots.diff_snapshots(spark, *paths)
    assert rows(found) == rows(whole.filter("status <> 'equal'").select(*found.columns))
    assert rows(snapshots.summarize_snapshots(spark, *paths)) == rows(compare.diff_summary(whole))
    return found


def test_one_day_of_sixty_is_read(spark, tmp_path):
    mine, theirs = days(spark, 60, bumps=[date(2026, 10, 7)]), days(spark, 60)
    found = same(spark, tmp_path, mine, theirs)
    assert found.count() == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = snapshots.diff_snapshots(spark, f"{tmp_path}/mine", f"{tmp_path}/theirs")
        executed = found._jdf.queryExecution()
        found._jdf.queryExecution().executedPlan().executeCollect()
        leaves = executed.executedPlan().collectLeaves()
        read = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert read == [1, 1]  # of 60 files on each side
    compared = snapshots.compared_snapshots(spark, f"{tmp_path}/mine", f"{tmp_path}/theirs")
    differing = {(r["level"], r["branch"]) for r in compared.filter("differs").collect()}
    assert differing == {("all", "all"), ("month", "2026-10"), ("day", "2026-10-07")}


def test_days_on_one_side_metadata_and_missing_dates(spark, tmp_path):
    more = [record("2026-09-03T05", "NG", "1"), record("2026-09-04T05", "NG", None)]
    mine = days(spark, 3, extra=more[:1])
    late = records_df(spark, more[1:]).selectExpr("*").drop("date").selectExpr("*", "CAST(NULL AS DATE) AS date")
    theirs = days(spark, 5).unionByName(late).replace("Demand", "demand", subset=["type-name"])
    same(spark, tmp_path, mine, theirs)


@pytest.mark.parametrize("n", [0, 2])
def test_equal_and_empty_snapshots(spark, tmp_path, n):
    found = same(spark, tmp_path, days(spark, n), days(spark, n))
    assert found.count() == 0


def test_very_many_days_stay_in_a_join(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "NAMED_DAYS", 2)
    same(spark, tmp_path, days(spark, 5, bumps=days_from(FIRST, 4)), days(spark, 5))


def test_digest_tells_what_order_and_pairs_would_hide(spark):
    one = records_df(spark, [record("2026-09-01T00", "D", "1"), record("2026-09-01T01", "D", "2")])
    day = digests.day_digests(one).collect()
    assert digests.day_digests(one.orderBy("period", ascending=False)).collect() == day
    twice = one.unionByName(one).unionByName(one)
    assert digests.day_digests(twice).first()["hash_xor"] == day[0]["hash_xor"]
    assert digests.day_digests(twice).first()["hash_sum"] != day[0]["hash_sum"]
    # null, the text null and text that moved to the next field are three things
    texts = [record("2026-09-01T00", "D", v, **{"value-units": u}) for v, u in ((None, "a"), ("null", "a"), ("a", None))]
    assert len({digests.day_digests(records_df(spark, [r])).first()["hash_xor"] for r in texts}) == 3
