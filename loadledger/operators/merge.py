"""Change-detecting upsert for tables without a transactional MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadledger.contract import DAILY_MEASURES, DAY_KEY, HOUR_KEY, HOURLY_MEASURES

INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


def differs(names: Sequence[str]) -> Column:
    """Any of the columns differs between source and target; null equals null."""
    return F.expr(" OR ".join(f"NOT (source.`{n}` <=> target.`{n}`)" for n in names))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    when: Column,
) -> DataFrame:
    """Target after the merge, with an ``action`` column.

    A source row with a new key is inserted. A matched row takes the ``update``
    columns when ``when`` holds, which sees both sides as ``source`` and
    ``target``. Target rows without a source row are kept; nothing is deleted.

    Each side must hold a key once, so no key can be hot in the join.
    """
    stored = target.withColumn("_stored", F.lit(True)).alias("target")
    arriving = source.select(*target.columns).withColumn("_arrived", F.lit(True)).alias("source")
    same_key = F.expr(" AND ".join(f"target.`{k}` = source.`{k}`" for k in keys))
    action = (
        F.when(F.col("_stored").isNull(), INSERTED)
        .when(F.col("_arrived").isNull(), KEPT)
        .when(when, UPDATED)
        .otherwise(UNCHANGED)
    )
    paired = stored.join(arriving, same_key, "full_outer").withColumn("action", action)

    def pick(name: str) -> str:
        if name in keys:
            return f"coalesce(target.`{name}`, source.`{name}`) AS `{name}`"
        taken = f"'{INSERTED}', '{UPDATED}'" if name in update else f"'{INSERTED}'"
        return (
            f"CASE WHEN action IN ({taken}) THEN source.`{name}` ELSE target.`{name}` END AS `{name}`"
        )

    return paired.selectExpr(*[pick(name) for name in target.columns], "action")


def merge_hourly(hourly: DataFrame, incoming: DataFrame) -> DataFrame:
    compared = [*HOURLY_MEASURES, "source_modified_at"]
    changed = differs(compared)
    return merge_upsert(hourly, incoming, HOUR_KEY, ["period_ts", "date", *compared], changed)


def merge_daily(daily: DataFrame, incoming: DataFrame) -> DataFrame:
    compared = [*DAILY_MEASURES, "source_modified_at"]
    return merge_upsert(daily, incoming, DAY_KEY, compared, differs(compared))


def merge_stats(merged: DataFrame) -> DataFrame:
    """Rows per merge outcome."""
    return merged.groupBy("action").agg(F.count(F.lit(1)).alias("row_count"))
