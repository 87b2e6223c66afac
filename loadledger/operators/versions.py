"""Versions of a reading: every one is kept, the newest is served."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadledger.contract import NEWEST, READING_KEY, VERSION_KEY
from loadledger.functions.columns import is_newer
from loadledger.operators.merge import merge_upsert


def latest_per_key(
    history: DataFrame,
    keys: Sequence[str] = READING_KEY,
    newest: Sequence[str] = NEWEST,
) -> DataFrame:
    """The newest version of every key.

    Spark limits each group to one row before the shuffle as well as after it,
    so a key with very many versions sends one row per input partition.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.col(name).desc() for name in newest])
    ranked = history.withColumn("_rank", F.row_number().over(order))
    return ranked.filter("_rank = 1").drop("_rank")


def new_versions(
    history: DataFrame, incoming: DataFrame, key: Sequence[str] = VERSION_KEY
) -> DataFrame:
    """Incoming rows whose version key history does not hold yet.

    History is first cut down to the incoming keys. For a small batch Spark
    broadcasts the batch's keys, so the large side is scanned but not shuffled.
    """
    key = list(key)
    known = history.select(key).join(incoming.select(key), key, "left_semi")
    return incoming.join(known, key, "left_anti")


def history_append(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert-only merge: history plus the versions it lacks; nothing is updated."""
    return history.unionByName(new_versions(history, incoming))


def merge_latest(
    latest: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = READING_KEY,
    newest: Sequence[str] = NEWEST,
) -> DataFrame:
    """Upsert in which an incoming row replaces a stored one only when it is newer.

    Both sides hold each key once. The result carries an ``action`` column.
    """
    rest = [name for name in latest.columns if name not in keys]
    newer = is_newer("source", "target", newest)
    return merge_upsert(latest, incoming, keys, update=rest, when=newer)


def revision_stats(history: DataFrame, keys: Sequence[str] = READING_KEY) -> DataFrame:
    """How often each key was published and how many different values it took.

    Counting per (key, value) first keeps one busy key spread over its values.
    """
    per_value = history.groupBy(*keys, "value").agg(
        F.expr("count(*) AS n"),
        F.expr("min(source_modified_at) AS first_at"),
        F.expr("max(source_modified_at) AS last_at"),
    )
    return per_value.groupBy(*keys).agg(
        F.expr("sum(n) AS versions"),
        F.expr("count(value) AS distinct_values"),
        F.expr("min(first_at) AS first_published_at"),
        F.expr("max(last_at) AS last_published_at"),
    )


def layer_counts(history: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows in history and in latest, and how many of the former are superseded."""
    one, none = F.lit(1), F.lit(0)
    sides = history.select(one.alias("h"), none.alias("l")).unionByName(
        latest.select(none.alias("h"), one.alias("l"))
    )
    sums = sides.agg(F.sum("h").alias("history_rows"), F.sum("l").alias("latest_rows"))
    return sums.withColumn("superseded_rows", F.col("history_rows") - F.col("latest_rows"))


def key_lookup(df: DataFrame, **key: object) -> DataFrame:
    """Rows whose columns equal the given values."""
    for name, value in key.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df
