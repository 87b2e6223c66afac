"""CSV snapshots of published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Fixed value: how snapshot files write a timestamp; the fraction may be absent.
READ_TIMESTAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
WRITE_TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def export_snapshot(df: DataFrame, path: str) -> None:
    """Write a headed CSV snapshot, one file per partition."""
    writer = df.write.option("header", "true").option("timestampFormat", WRITE_TIMESTAMP)
    writer.csv(path)


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a headed CSV snapshot with a declared schema; a leading BOM is ignored.

    A file whose header does not fit the schema, or a malformed row, is an error.
    """
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("timestampFormat", READ_TIMESTAMP)
        .option("mode", "FAILFAST")
        .csv(path)
    )
