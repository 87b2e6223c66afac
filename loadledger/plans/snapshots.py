"""Snapshots with digests beside them, and their comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadledger.contract import READING_KEY, RECORD_FIELDS, RECORD_SCHEMA
from loadledger.operators.digests import (
    compare_digests,
    day_digests,
    diff_counts,
    differing_days,
    digest_diff,
    digest_tree,
)

SNAPSHOT_SCHEMA = T.StructType([*RECORD_SCHEMA.fields, T.StructField("date", T.DateType())])
DIGESTS = "level string, branch string, row_count bigint, hash_xor bigint, hash_sum decimal(38,0)"
# Dates that a scan's filter names one by one; beyond, days are chosen by a join.
NAMED_DAYS = 1000


def write_snapshot(df: DataFrame, path: str, fields: Sequence[str] = RECORD_FIELDS) -> None:
    """Rows by ``date`` under ``path/rows``, the digests of their days under ``path/digests``.

    Digests are taken of what was written, so they never tell of other rows than the files hold.
    """
    spark, rows = df.sparkSession, f"{path.rstrip('/')}/rows"
    df.hint("rebalance", F.col("date")).write.partitionBy("date").parquet(rows)
    written = spark.read.schema(df.schema).parquet(rows)
    day_digests(written, fields).coalesce(1).write.parquet(f"{path.rstrip('/')}/digests")


def snapshot_rows(spark: SparkSession, path: str, schema: T.StructType = SNAPSHOT_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/rows")


def snapshot_digests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DIGESTS).parquet(f"{path.rstrip('/')}/digests")


def compared_snapshots(spark: SparkSession, mine: str, theirs: str) -> DataFrame:
    """Branches of both trees side by side; only digests are read."""
    return compare_digests(*(digest_tree(snapshot_digests(spark, path)) for path in (mine, theirs)))


def diff_snapshots(
    spark: SparkSession,
    mine: str,
    theirs: str,
    keys: Sequence[str] = READING_KEY,
    fields: Sequence[str] = RECORD_FIELDS,
    schema: T.StructType = SNAPSHOT_SCHEMA,
) -> DataFrame:
    """What differs between two snapshots, as ``digest_diff``; files of days that agree are not opened.

    Only the dates that differ come to the driver, one per day at most; where there
    are very many, they stay in a join instead.
    """
    days = differing_days(compared_snapshots(spark, mine, theirs))
    named = days.limit(NAMED_DAYS + 1).collect()
    sides = [snapshot_rows(spark, path, schema) for path in (mine, theirs)]
    if len(named) <= NAMED_DAYS:
        dates = [r["date"] for r in named]
        wanted = F.col("date").isin([d for d in dates if d is not None])
        if None in dates:
            wanted = wanted | F.col("date").isNull()
        chosen = [side.filter(wanted) for side in sides]
    else:
        on = F.col("s.date").eqNullSafe(F.col("d.date"))
        chosen = [side.alias("s").join(days.alias("d"), on, "left_semi") for side in sides]
    return digest_diff(*chosen, keys, fields)


def summarize_snapshots(spark: SparkSession, mine: str, theirs: str) -> DataFrame:
    """Keys per outcome; the equal ones are counted by digests."""
    compared = compared_snapshots(spark, mine, theirs)
    return diff_counts(compared, diff_snapshots(spark, mine, theirs))
