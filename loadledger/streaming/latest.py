"""The newest version of every reading as streaming state.

State holds one row per key, the greatest by the order of versions, in a store
on the executors' disks that is checkpointed to the shared folder. Each
micro-batch gives out the keys whose newest version it brought.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadledger.contract import HISTORY_SCHEMA, NEWEST, READING_KEY
from loadledger.operators.versions import latest_per_key
from loadledger.session import pin_utc

# The setting that chooses a state store, and the one that keeps state on disk.
STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """For queries that start within: they keep the setting they started with."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ON_DISK)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def newest_versions(
    versions: DataFrame, keys: Sequence[str] = READING_KEY, newest: Sequence[str] = NEWEST
) -> DataFrame:
    """The newest version of every key, as one aggregate; works on streams and on tables."""
    rest = [name for name in versions.columns if name not in (*keys, *newest)]
    best = F.max(F.struct(*newest, *rest)).alias("best")
    return versions.groupBy(*keys).agg(best).select(*keys, "best.*").select(*versions.columns)


def stream_latest(
    spark: SparkSession, history: str, updates: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Start a query over the history rows that arrive as files below ``history``, then stop.

    The keys that a micro-batch changes are written to ``updates``, in a folder of
    the batch's number, so a batch that is replayed writes the same folder again.
    """
    pin_utc(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates.rstrip('/')}/batch={number}")

    arriving = (
        spark.readStream.schema(HISTORY_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(history)
    )
    with _state_on_disk(spark):
        return (
            newest_versions(arriving)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def served_latest(spark: SparkSession, updates: str) -> DataFrame:
    """What the stream has brought so far: of each key the newest row that it gave out."""
    files = spark.read.schema(HISTORY_SCHEMA).option("recursiveFileLookup", "true")
    return latest_per_key(files.parquet(updates))
