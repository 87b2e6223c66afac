"""Reading the given tables and holding intermediate rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.session import stage

__all__ = ["sampled_texts", "shuffle_partitions", "stage", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster sizes to its input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sampled_texts(docs: DataFrame, size: int, pattern: str = "") -> DataFrame:
    """``text`` of the ``size`` documents with the least hashes, among those that match.

    Only hashes are ordered; the texts of the chosen ones, a bounded list that is
    broadcast, are then fetched from the table.
    """
    text = F.col("text").cast("string")
    keyed = docs.select(F.xxhash64("doc_id", text).alias("key"), text.alias("text"))
    fit = keyed.filter(F.col("text").rlike(pattern))
    chosen = fit.select("key").orderBy("key").limit(size)
    found = keyed.join(F.broadcast(chosen.distinct()), "key")
    return found.dropDuplicates(["key"]).select("text")
