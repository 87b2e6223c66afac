"""The four published tables, as date-partitioned parquet under one root.

A run writes its dates into folders of its own. One small file then names, per
layer and date, the run that counts from now on: writing it is the commit, and
readers see all of a run or nothing of it. History only grows, so all committed
runs count there. One writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadledger.contract import (
    DAILY_SCHEMA,
    HISTORY_SCHEMA,
    HOURLY_SCHEMA,
    LATEST_SCHEMA,
)
from loadledger.functions.columns import period_date
from loadledger.operators.quality import Watch
from loadledger.operators.versions import key_lookup
from loadledger.session import folders_of_age, remove

LAYERS: dict[str, T.StructType] = {
    "history": HISTORY_SCHEMA,
    "latest": LATEST_SCHEMA,
    "hourly": HOURLY_SCHEMA,
    "daily": DAILY_SCHEMA,
}
COMMITS = "layer string, date date, run string, seq bigint, at timestamp"


def stored_schema(layer: str) -> T.StructType:
    """The layer's columns plus the partition column ``date`` at the end."""
    fields = [f for f in LAYERS[layer].fields if f.name != "date"]
    return T.StructType([*fields, T.StructField("date", T.DateType())])


def run_path(root: str, layer: str, run: str) -> str:
    return f"{root.rstrip('/')}/{layer}/run={run}"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root.rstrip('/')}/_manifest"
    nothing = spark.createDataFrame([], COMMITS)
    nothing.write.mode("ignore").parquet(path)
    return spark.read.schema(COMMITS).parquet(path)


def committed(spark: SparkSession, root: str) -> DataFrame:
    """(layer, date, run): what counts now. As many rows as there are days, or versions of them."""
    every = _commits(spark, root)
    newest = every.filter("layer <> 'history'").groupBy("layer", "date")
    kept = every.filter("layer = 'history'").select("layer", "date", "run").distinct()
    return kept.unionByName(newest.agg(F.max_by("run", "seq").alias("run")))


def commit(spark: SparkSession, root: str, entries: DataFrame) -> None:
    """Make (layer, date, run) rows count, all at once: they are one file, moved into place."""
    top = _commits(spark, root).agg(F.coalesce(F.max("seq"), F.lit(0)) + 1).first()[0]
    rows = entries.select(
        "layer", "date", "run", F.lit(top).cast("bigint").alias("seq"), F.current_timestamp().alias("at")
    )
    rows.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_manifest")


def _folders(spark: SparkSession, root: str, layer: str, days: Sequence[date] | None) -> list[str]:
    entries = committed(spark, root).filter(F.col("layer") == layer)
    if days is not None:
        wanted = spark.createDataFrame([(day,) for day in days], "date date")
        entries = entries.join(wanted, "date", "left_semi")
    found = entries.select("run", F.col("date").cast("string").alias("date")).distinct()
    return sorted(f"{run_path(root, layer, r['run'])}/date={r['date']}" for r in found.collect())


def read_layer(
    spark: SparkSession, root: str, layer: str, days: Sequence[date] | None = None
) -> DataFrame:
    """A layer with its partition column, or only the given dates of it.

    The folders that count are named one by one, so files of other dates, and of
    runs that count no more, are not even listed.
    """
    folders = _folders(spark, root, layer, days)
    if not folders:
        return spark.createDataFrame([], stored_schema(layer))
    reader = spark.read.schema(stored_schema(layer))
    return reader.option("basePath", f"{root.rstrip('/')}/{layer}").parquet(*folders)


def published(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """A layer in its published column order."""
    return read_layer(spark, root, layer).select(*LAYERS[layer].names)


def find(spark: SparkSession, root: str, layer: str, **key: object) -> DataFrame:
    """Rows of a stored layer by key. A period or date in the key prunes partitions."""
    day = key.get("date") or str(key.get("period", ""))[:10]
    day = date.fromisoformat(str(day)) if day else None
    rows = read_layer(spark, root, layer, [day] if day else None)
    return key_lookup(rows, **key).select(*LAYERS[layer].names)


def with_date(records: DataFrame) -> DataFrame:
    """Add the partition date of a reading."""
    return records.withColumn("date", period_date("period"))


def write_run(
    df: DataFrame,
    root: str,
    layer: str,
    run: str,
    watch: Watch | None = None,
    tallies: Sequence[str] = (),
) -> DataFrame:
    """Write a run's rows of a layer, not yet visible, and read them back.

    Columns beyond the layer's own are kept for the run and never published.
    Rebalancing brings a date's rows together for few, large files, yet lets
    adaptive execution split a date that is much larger than the others.
    ``watch`` judges the rows as they are written.
    """
    own = stored_schema(layer).names
    extra = [name for name in df.columns if name not in own]
    rows = df.select(*[n for n in own if n != "date"], *extra, "date")
    path = run_path(root, layer, run)
    if watch is None:
        dealt = rows.hint("rebalance", F.col("date"))
    else:
        dealt = watch.watched(watch.numbered(rows).hint("rebalance", F.col("date")), tallies)
    dealt.write.partitionBy("date").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def publish(df: DataFrame, root: str, layer: str, run: str) -> None:
    """Write and commit rows of one layer."""
    spark = df.sparkSession
    dates = write_run(df, root, layer, run).select("date").distinct()
    commit(spark, root, dates.select(F.lit(layer).alias("layer"), "date", F.lit(run).alias("run")))


def superseded(spark: SparkSession, root: str, keep: timedelta) -> DataFrame:
    """(layer, date, run) that counted once, and for longer than ``keep`` have not."""
    order = Window.partitionBy("layer", "date").orderBy("seq")
    replaced = _commits(spark, root).filter("layer <> 'history'").withColumn("gone", F.lead(F.coalesce("at", F.timestamp_seconds(F.lit(0)))).over(order))
    past = F.current_timestamp() - F.lit(keep)
    return replaced.filter(F.col("gone") <= past).select("layer", "date", "run")


def clean_up(spark: SparkSession, root: str, keep: timedelta) -> None:
    """Remove folders that have not counted for ``keep``: superseded dates and runs that died.

    No run does this by itself: whatever was read from the tables, or registered
    as such, stays readable until the caller decides that nobody holds it any
    more. A run still at work has younger folders than a sensible ``keep``.
    """
    for row in superseded(spark, root, keep).toLocalIterator():
        remove(spark, f"{run_path(root, row['layer'], row['run'])}/date={row['date']}")
    known = {r["run"] for r in _commits(spark, root).select("run").distinct().collect()}
    for path in folders_of_age(spark, f"{root.rstrip('/')}/*/run=*", keep):
        if path.rsplit("run=", 1)[1].rstrip("/") not in known:
            remove(spark, path)


def days_of(df: DataFrame) -> list[date]:
    """The dates that occur in ``df``; the calendar bounds how many there can be."""
    found = df.select("date").filter("date IS NOT NULL").distinct()
    return sorted(row["date"] for row in found.collect())


def on_dates_of(layer: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of ``layer`` on the dates that occur in ``changed``."""
    return layer.join(changed.select("date").distinct(), "date", "left_semi")


def register_tables(spark: SparkSession, root: str, database: str) -> None:
    """Make what counts now available to SQL as ``database.layer``.

    The tables hold the partitions by name; register again after a run.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    entries = committed(spark, root).collect()
    for layer in LAYERS:
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in stored_schema(layer).fields
        )
        spark.sql(f"DROP TABLE IF EXISTS {database}.{layer}")
        spark.sql(
            f"CREATE TABLE {database}.{layer} ({columns}, run string) USING parquet "
            f"PARTITIONED BY (run, date) LOCATION '{root.rstrip('/')}/{layer}'"
        )
        parts = " ".join(
            f"PARTITION (run = '{e['run']}', date = DATE'{e['date']}')"
            for e in entries
            if e["layer"] == layer
        )
        if parts:
            spark.sql(f"ALTER TABLE {database}.{layer} ADD IF NOT EXISTS {parts}")
