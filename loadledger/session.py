"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Series hours are UTC hours; another zone would skip or double one hour a year."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_setting(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` as the session has it, or the folder set on its context."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return named or context.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share."""
    root = shared_setting(spark)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses. It is not created."""
    return f"{shared_root(spark)}/loadledger/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark can write to, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def folders_of_age(spark: SparkSession, pattern: str, age: timedelta) -> Iterator[str]:
    """Paths that match the pattern and have not changed for ``age``, by the session's clock."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    now = spark.sql("SELECT unix_millis(current_timestamp())").first()[0]
    for status in system.globStatus(place) or []:
        if timedelta(milliseconds=now - status.getModificationTime()) >= age:
            yield status.getPath().toString()


def clear_staged(spark: SparkSession, age: timedelta) -> None:
    """Remove what ``stage`` and ``fresh_dir`` left in the shared folder at least ``age`` ago.

    A lazy result reads such folders for as long as it is held, so nothing removes them by
    itself; call this with more than the time that any job and result may take.
    """
    for path in folders_of_age(spark, f"{shared_root(spark)}/loadledger/*", age):
        remove(spark, path)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later steps then reread finished files instead of repeating the plan, and a
    lost executor costs no recomputation beyond the files' own reader task.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder under the shared one that goes when the step that uses it ends."""
    path = fresh_dir(spark, label)
    try:
        yield path
    finally:
        remove(spark, path)


def stage_in(df: DataFrame, folder: str, label: str) -> DataFrame:
    """Like ``stage``, below a folder that its owner removes."""
    path = f"{folder}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
