from __future__ import annotations

import random
from datetime import timedelta

import pytest
from conftest import rows
from series import T1, T2, T3, history, version

from loadledger.operators import merge, versions

COLUMNS = ["period", "respondent", "type", "value"]


@pytest.mark.parametrize(
    ("stored", "expected"),
    [
        ([version(10.0)], 10.0),
        ([version(10.0, T1, "a"), version(12.0, T2, "b")], 12.0),
        ([version(10.0, T1, "a"), version(12.0, T1, "b")], 12.0),
        ([version(12.0, T2, "b"), version(10.0, T1, "c")], 12.0),
        ([version(10.0, T1, "a", "h1"), version(12.0, T1, "a", "h2")], 12.0),
        ([version(10.0, T1, "a"), version(12.0, T2, "b"), version(15.0, T3, "c")], 15.0),
    ],
    ids=["single", "revision", "equal time", "late older file", "equal path", "three"],
)
def test_latest(spark, stored, expected):
    assert [r["value"] for r in versions.latest_per_key(history(spark, stored)).collect()] == [expected]


def test_history_holds_a_version_once(spark):
    stored = [version(10.0, T1, "a", "h1")]
    same = version(10.0, T1, "a", "h1")
    touched = version(10.0, T2, "a", "h1")
    overwritten = version(12.0, T2, "a", "h2")
    after = versions.history_append(history(spark, stored), history(spark, [same]))
    assert after.count() == 1
    after = versions.history_append(history(spark, stored), history(spark, [touched]))
    assert [r["source_modified_at"] for r in after.collect()] == [T1]
    after = versions.history_append(history(spark, stored), history(spark, [overwritten]))
    assert after.count() == 2
    assert [r["value"] for r in versions.latest_per_key(after).collect()] == [12.0]


def random_versions(seed, n):
    """Few keys with many versions; one key has a third of all rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hour = 0 if rng.random() < 0.34 else rng.randrange(6)
        kind = "D" if hour == 0 else rng.choice(["D", "DF"])
        at = T1 + timedelta(minutes=rng.randrange(40))
        out.append(version(float(i), at, f"p{rng.randrange(30):02d}", f"h{i:05d}",
                           f"2026-09-26T{hour:02d}", kind))
    return out


def brute_latest(stored):
    best = {}
    for row in stored:
        key, order = row[:3], (row[6], row[5], row[7])
        if key not in best or order > best[key][0]:
            best[key] = (order, row)
    return sorted((row for _, row in best.values()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_latest_and_merge_against_brute_force(spark, seed):
    stored = random_versions(seed, 300)
    rng = random.Random(seed)
    first = [row for row in stored if rng.random() < 0.6]
    second = [row for row in stored if row not in first]
    expected = brute_latest(stored)
    assert rows(versions.latest_per_key(history(spark, stored).repartition(5))) == expected
    for a, b in ((first, second), (second, first)):
        merged = versions.merge_latest(
            versions.latest_per_key(history(spark, a)), versions.latest_per_key(history(spark, b))
        )
        assert rows(merged.drop("action")) == expected


def test_merge_latest_actions(spark):
    target = [version(1.0, T2, "b", period="2026-09-26T00"), version(1.0, T2, "b", period="2026-09-26T01"),
              version(1.0, T2, "b", period="2026-09-26T02")]
    source = [version(2.0, T3, "c", period="2026-09-26T00"), version(2.0, T1, "c", period="2026-09-26T01"),
              version(2.0, T1, "c", period="2026-09-26T03")]
    merged = versions.merge_latest(history(spark, target), history(spark, source))
    found = {r["period"][-2:]: (r["action"], r["value"]) for r in merged.collect()}
    assert found == {"00": ("updated", 2.0), "01": ("unchanged", 1.0), "02": ("kept", 1.0),
                     "03": ("inserted", 2.0)}
    counts = {r["action"]: r["row_count"] for r in merge.merge_stats(merged).collect()}
    assert counts == {"updated": 1, "unchanged": 1, "kept": 1, "inserted": 1}


def test_revision_stats_and_counts(spark):
    stored = [version(10.0, T1, "a"), version(10.0, T2, "b"), version(12.0, T3, "c"),
              version(5.0, T1, "a", kind="DF")]
    df = history(spark, stored)
    found = {r["type"]: (r["versions"], r["distinct_values"], r["first_published_at"], r["last_published_at"])
             for r in versions.revision_stats(df).collect()}
    assert found == {"D": (3, 2, T1, T3), "DF": (1, 1, T1, T1)}
    counts = versions.layer_counts(df, versions.latest_per_key(df)).first()
    assert tuple(counts) == (4, 2, 2)


def test_key_lookup(spark):
    df = history(spark, [version(1.0), version(2.0, kind="DF"), version(3.0, period="2026-09-26T01")])
    found = versions.key_lookup(df, period="2026-09-26T00", respondent="US48")
    assert sorted(r["value"] for r in found.collect()) == [1.0, 2.0]
