"""Stored checkpoints: how far each respondent has been delivered.

Every save appends; nothing is replaced. The newest hour per respondent counts,
so the state cannot move back, and a save that is cut short or repeated does no
harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadledger.contract import SeriesContract
from loadledger.operators.quality import Rule, enforce, quality_report

# The fields of a checkpoint. A form for a single series names no
# respondent, and an older one names the hour differently.
CHECKPOINT_FIELDS = (
    "respondent string, last_uploaded_hour string, updated_at_utc string, "
    "last_successful_hour string"
)


def read_checkpoint(spark: SparkSession, path: str, contract: SeriesContract) -> DataFrame:
    """State (respondent, last_uploaded_hour); empty when nothing was saved yet.

    A saved value without a respondent is that of the contract's only one; where
    the contract has several or leaves them open, it is refused.
    """
    nothing = spark.createDataFrame([], CHECKPOINT_FIELDS)
    nothing.write.mode("ignore").json(path)
    saved = spark.read.schema(CHECKPOINT_FIELDS).option("multiLine", "false").json(path)
    only = contract.respondents[0] if len(contract.respondents or ()) == 1 else None
    named = saved.withColumn("respondent", F.coalesce("respondent", F.lit(only).cast("string")))
    enforce(quality_report(named, [Rule("checkpoint names its respondent", "respondent IS NULL")]))
    hour = F.expr("max(coalesce(last_uploaded_hour, last_successful_hour))")
    return named.groupBy("respondent").agg(hour.alias("last_uploaded_hour"))


def write_checkpoint(state: DataFrame, path: str) -> None:
    """Save a state. It is one short row per respondent, spread over few files."""
    saved = state.withColumn(
        "updated_at_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    )
    rows = saved.select("respondent", "last_uploaded_hour", "updated_at_utc")
    rows.hint("rebalance").write.mode("append").json(path)
