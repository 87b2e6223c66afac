"""Snapshots compared by digests: only the branches that differ are read and joined.

A snapshot carries, beside its rows, one digest per day: the number of rows and
two sums of row hashes that do not depend on the order of rows. Digests of
months and of the whole are rolled up from those. Two snapshots are compared
from the top; below a branch whose digests agree nothing is looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.contract import READING_KEY, RECORD_FIELDS
from loadledger.operators.compare import snapshot_diff

LEVELS = ("all", "month", "day")
DIGEST = ("row_count", "hash_xor", "hash_sum")
# The branch that a row without date belongs to, and that of the whole.
NO_DATE, WHOLE = "", "all"


def _row_hash(fields: Sequence[str]) -> str:
    """Hash of the fields with what tells null from text, so that no two rows look alike by accident."""
    marked = ", ".join(f"`{n}` IS NULL, `{n}`" for n in fields)
    return f"xxhash64({marked})"


def _rolled(df: DataFrame, level: str, branch: str) -> DataFrame:
    return df.groupBy(F.expr(branch).alias("branch")).agg(
        F.lit(level).alias("level"),
        F.expr("CAST(sum(row_count) AS BIGINT) AS row_count"),
        F.expr("bit_xor(hash_xor) AS hash_xor"),
        F.expr("CAST(sum(hash_sum) AS DECIMAL(38,0)) AS hash_sum"),
    )


def day_digests(df: DataFrame, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """One digest per ``date``: (level, branch, row_count, hash_xor, hash_sum).

    The sum tells what an exclusive or alone would not, a pair of equal rows more
    or less. Rows fold on the map side, so a day of any size is no large group.
    """
    rows = df.selectExpr(
        f"coalesce(CAST(date AS STRING), '{NO_DATE}') AS day",
        "1L AS row_count",
        f"{_row_hash(fields)} AS hash_xor",
    ).withColumn("hash_sum", F.expr("CAST(hash_xor AS DECIMAL(20,0))"))
    return _rolled(rows, "day", "day").select("level", "branch", *DIGEST)


def digest_tree(days: DataFrame) -> DataFrame:
    """Digests of the days, their months and the whole, from those of the days alone."""
    months = _rolled(days, "month", "substring(branch, 1, 7)")
    whole = _rolled(days, "all", f"'{WHOLE}'")
    names = ("level", "branch", *DIGEST)
    return days.select(*names).unionByName(months.select(*names)).unionByName(whole.select(*names))


def compare_digests(mine: DataFrame, theirs: DataFrame) -> DataFrame:
    """(level, branch, my_rows, their_rows, differs) for every branch of two trees."""
    sides = [
        side.select("level", "branch", *[F.col(n).alias(f"{prefix}_{n}") for n in DIGEST])
        for side, prefix in ((mine, "my"), (theirs, "their"))
    ]
    paired = sides[0].join(sides[1], ["level", "branch"], "full_outer")
    agrees = " AND ".join(f"my_{n} <=> their_{n}" for n in DIGEST)
    return paired.selectExpr(
        "level",
        "branch",
        "coalesce(my_row_count, 0L) AS my_rows",
        "coalesce(their_row_count, 0L) AS their_rows",
        f"NOT ({agrees}) AS differs",
    )


def differing_days(compared: DataFrame) -> DataFrame:
    """``date`` of the days that differ, found from the top: days only count below differing months."""
    differing = compared.filter("differs")
    tops = differing.filter(F.col("level") == "all").select(F.lit(WHOLE).alias("root"))
    months = differing.filter(F.col("level") == "month").select(
        F.col("branch").alias("month"), F.lit(WHOLE).alias("root")
    )
    days = differing.filter(F.col("level") == "day").select(
        F.substring("branch", 1, 7).alias("month"), "branch"
    )
    below = days.join(months.join(tops, "root", "left_semi"), "month", "left_semi")
    return below.select(F.expr(f"CAST(nullif(branch, '{NO_DATE}') AS DATE)").alias("date"))


def digest_diff(
    mine: DataFrame,
    theirs: DataFrame,
    keys: Sequence[str] = READING_KEY,
    fields: Sequence[str] = RECORD_FIELDS,
) -> DataFrame:
    """The rows of ``snapshot_diff`` that are not equal, for rows of the differing days of both sides."""
    return snapshot_diff(mine, theirs, keys, fields).filter("status <> 'equal'")


def diff_counts(compared: DataFrame, diff: DataFrame) -> DataFrame:
    """Keys per outcome, as ``diff_summary`` has them, without a look at days that agree.

    A key of mine that ``diff`` does not name is equal.
    """
    found = diff.groupBy("status").agg(F.count(F.lit(1)).alias("key_count"))
    of_mine = compared.filter(F.col("level") == "day").select(F.col("my_rows").alias("key_count"))
    named = found.filter("status <> 'extra'").select((-F.col("key_count")).alias("key_count"))
    equal = of_mine.unionByName(named).select(F.lit("equal").alias("status"), "key_count")
    sums = found.unionByName(equal).groupBy("status").agg(F.sum("key_count").alias("key_count"))
    return sums.filter("key_count > 0")
