"""History as intervals of validity, and what was served at given times.

A version counts from its time until the next one's. Many (key, time) pairs are
answered together: time is cut into buckets, versions and questions meet per
key and bucket, and the version that a bucket begins with is carried in from those
before it. A key with very many versions is thus spread over its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadledger.contract import NEWEST, READING_KEY

BUCKET_SECONDS = 86_400
SERVED = ("value", "value_units", "source_path", "source_modified_at", "content_hash")


def validity_intervals(history: DataFrame, keys: Sequence[str] = READING_KEY) -> DataFrame:
    """History with ``valid_from`` and ``valid_to``; the newest version of a key has no end.

    Of versions with one time only the one that counts last has an interval that
    is not empty; the others are kept, with an end equal to their start.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.col(name) for name in NEWEST])
    return history.withColumn("valid_from", F.col("source_modified_at")).withColumn(
        "valid_to", F.lead("source_modified_at").over(order)
    )


def _bucket(time: str, seconds: int) -> str:
    return f"CAST(floor(unix_micros({time}) / ({seconds} * 1000000L)) AS BIGINT)"


def _version(names: Sequence[str]) -> str:
    order = ", ".join(f"`{n}`" for n in NEWEST)
    rest = ", ".join(f"`{n}`" for n in names if n not in NEWEST)
    return f"struct({order}, {rest})"


def as_of(
    history: DataFrame,
    asked: DataFrame,
    keys: Sequence[str] = READING_KEY,
    at: str = "as_of",
    seconds: int = BUCKET_SECONDS,
    served: Sequence[str] = SERVED,
) -> DataFrame:
    """``asked`` (keys and ``at``) with the version of each key that counted then; null before the first.

    A version counts from its very time on. A pair that is asked several times
    is answered each time; null keys or times get no answer but stay. History with the same
    version more than once answers as if it held it once.
    """
    keys = list(keys)
    versions = history.filter("source_modified_at IS NOT NULL").selectExpr(
        *keys, f"{_bucket('source_modified_at', seconds)} AS _bucket", f"{_version(served)} AS _version"
    )
    pairs = asked.withColumn("_bucket", F.expr(_bucket(f"`{at}`", seconds)))

    # The last version of each bucket, folded on the map side, is what the next bucket begins with.
    last = versions.groupBy(*keys, "_bucket").agg(F.max("_version").alias("_last"))
    wanted = pairs.select(*keys, "_bucket").distinct().withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType))
    heads = last.unionByName(wanted).groupBy(*keys, "_bucket").agg(F.max("_last").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_version"))
    carried = carried.filter("_version IS NOT NULL")

    # Within a bucket a question takes the last version that is not after it.
    asks = [c for c in pairs.columns if c not in keys and c != "_bucket"]
    question = F.struct(*[F.col(f"`{c}`") for c in asks]).alias("_asked")
    nothing = F.lit(None).cast(last.schema["_last"].dataType).alias("_version")
    told = [
        carried.select(*keys, "_bucket", F.lit(None).cast("timestamp").alias("_time"), F.lit(0).alias("_kind"), "_version"),
        versions.select(*keys, "_bucket", F.col("_version.source_modified_at").alias("_time"), F.lit(1).alias("_kind"), "_version"),
    ]
    rows = pairs.select(*keys, "_bucket", F.col(f"`{at}`").alias("_time"), F.lit(2).alias("_kind"), nothing, question)
    for part in told:
        rows = rows.unionByName(part.withColumn("_asked", F.lit(None).cast(rows.schema["_asked"].dataType)))
    sequence = Window.partitionBy(*keys, "_bucket").orderBy(
        F.asc_nulls_first("_time"), "_kind", "_version"
    )
    found = F.last("_version", ignorenulls=True).over(
        sequence.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answered = rows.withColumn("_found", found).filter("_kind = 2")
    known = F.expr(" AND ".join([*[f"`{k}` IS NOT NULL" for k in keys], "_time IS NOT NULL"]))
    return answered.select(
        *keys,
        *[F.col(f"_asked.`{c}`").alias(c) for c in asks],
        *[F.when(known, F.col(f"_found.`{n}`")).alias(n) for n in served],
    )
