"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from loadledger import oracle, workload
from loadledger.operators import versions

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")

QUERIES = workload.QUERIES
ORACLE = oracle.queries()
# These run jobs while they are built; their plans only read back what was written.
WRITING = {
    "scan_landing", "land_days", "decode_payload", "content_fingerprint", "explode_records",
    "classify_days", "landing_conflicts", "dq_declared_total", "dq_accepted_files", "read_snapshot",
    "incremental_refresh", "refresh_outcome", "stream_bronze", "layers_from_landing", "ingest_days",
    "stream_late_files", "pipeline_touched_files", "observed_order", "complete_days_refresh", "registered_tables",
    "stream_notices", "stream_latest_state", "packed_zone", "record_digest", "gated_write", "digest_diff", "digest_summary", "trailing_refresh",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def comparable(value):
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return repr(value) if isinstance(value, float) else str(value)


def table(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(comparable(row[i]) for i in order) for row in found)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, df.collect()) == expected


def test_entry(spark):
    found = driver.entry(spark)
    assert found.columns[:3] == ["date", "respondent", "hour_count"]
    assert found.count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITING])
def test_plan_has_no_pairwise_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text


def test_latest_limits_groups_before_the_shuffle(spark):
    text = plan(workload.latest_per_key(spark, SF_DIR))
    limits = text.count("WindowGroupLimit")
    assert limits == 2
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")
    assert text.count("Exchange") == 1


def test_scans_read_only_needed_columns(spark):
    text = plan(workload.parse_period(spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text


def test_small_batch_does_not_shuffle_history(spark, tmp_path):
    rows = workload.history(spark, SF_DIR)
    rows.write.parquet(str(tmp_path / "history"))
    stored = spark.read.parquet(str(tmp_path / "history"))
    fresh = versions.new_versions(stored, stored.limit(5))
    fresh.collect()
    text = plan(fresh)
    assert "BroadcastHashJoin" in text.split("Initial Plan")[0]
