"""What each filter of a chain removes, in every order of the chain.

The sets of filters that have run are the states of a lattice; applying one more
filter is an edge. What an edge removes depends on its state only, not on the
order that led there, so documents are counted once per state and filter. Orders
are paths from the empty to the full set: counting them forwards and backwards
gives the number of orders through every edge. Its removals times that number,
summed over a filter's edges, are the filter's Shapley sum; a step of an order is read from
the edge that the order takes there.

Documents only enter as counts per set of failed filters, so everything after
one pass over the texts works on a few rows per part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
# White space that ends a word, capitals, and the signs of filter D.
SPACES = "\t\n\x0b\f\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = "[#$%&*|]"
MIN_WORDS = 200
COPY = 16  # the bit of filter E

COUNTS = ("docs", "good", "toxic")


@dataclass(frozen=True)
class Edge:
    """Applying filter ``bit`` where the filters of ``state`` have run."""

    state: int
    bit: int
    orders: int  # orders that take this edge
    steps: tuple[tuple[str, int], ...]  # those orders, and the step at which they do


def lattice(filters: str = FILTERS) -> list[Edge]:
    """All edges with the number of orders through them, by forward and backward counts."""
    bits = [1 << n for n in range(len(filters))]
    full = (1 << len(filters)) - 1
    reaching = [1] + [0] * full  # paths from the empty set
    for state in range(1, full + 1):
        reaching[state] = sum(reaching[state ^ b] for b in bits if state & b)
    leaving = [0] * full + [1]  # paths to the full set
    for state in range(full - 1, -1, -1):
        leaving[state] = sum(leaving[state | b] for b in bits if not state & b)

    taken: dict[tuple[int, int], list[tuple[str, int]]] = {}

    def walk(state: int, order: str, path: list[tuple[int, int]]) -> None:
        if state == full:
            for step, edge in enumerate(path, 1):
                taken.setdefault(edge, []).append((order, step))
        for name, b in zip(filters, bits):
            if not state & b:
                walk(state | b, order + name, [*path, (state, b)])

    walk(0, "", [])
    return [
        Edge(state, b, reaching[state] * leaving[state | b], tuple(taken[state, b]))
        for state in range(full)
        for b in bits
        if not state & b
    ]


def failed_by_text(text: Column) -> Column:
    """Bits of filters A to D that a text fails."""
    spaced = F.translate(text, SPACES, " " * len(SPACES))
    words = F.array_remove(F.split(spaced, " "), "")
    return F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) < MIN_WORDS, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(w)) < 50 * F.size(w), 2).otherwise(0)
        + F.when(
            100 * (F.length(text) - F.length(F.translate(text, CAPITALS, ""))) > 2 * F.length(text), 4
        ).otherwise(0)
        + F.when(text.rlike(SIGNS), 8).otherwise(0),
    )[0]


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in COUNTS]


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, docs, good, toxic): documents per part and set of failed filters.

    Equal texts fold per part before they meet, so a text that many rows hold is
    no large group. Of equal texts those with the least doc_id pass filter E.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        failed_by_text(text).alias("failed"),
    )
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *[F.max((F.col(column) == 1).cast("int")).alias(n) for column, n in (("quality", "good"), ("toxic", "toxic"))]
    )
    per_id = read.groupBy("doc_id", "digest", "part", "failed").agg(F.count(F.lit(1)).alias("docs"))
    known = per_id.join(marked, "doc_id", "left").withColumns(
        {n: F.when(F.col(n) == 1, F.col("docs")).otherwise(0) for n in ("good", "toxic")}
    )
    # Null ids are neither smaller nor larger than others: such rows pass E.
    lone = F.col("doc_id").isNull().alias("lone")
    per_text = known.groupBy("digest", "part", "failed", lone).agg(
        *_sums(), F.min("doc_id").alias("least"), F.min_by(F.struct(*COUNTS), "doc_id").alias("first")
    )
    first_id = F.min("least").over(Window.partitionBy("digest"))  # a row per part and text
    judged = per_text.withColumn("is_first", F.col("least") == first_id)
    passing = {n: f"CASE WHEN lone THEN {n} WHEN is_first THEN first.{n} ELSE 0 END" for n in COUNTS}
    split = ", ".join(
        ["failed", *passing.values(), f"failed | {COPY}", *[f"{n} - {p}" for n, p in passing.items()]]
    )
    rows = judged.selectExpr("part", f"stack(2, {split}) AS (failed, {', '.join(COUNTS)})")
    return rows.filter("docs > 0").groupBy("part", "failed").agg(*_sums())


def audit(spark: SparkSession, counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, from (part, failed, docs, good, toxic).

    A part has at most one row per set of filters, so its rows fit one list.
    """
    edges = lattice(filters)
    steps = [(e.state, e.bit, order, step) for e in edges for order, step in e.steps]
    table = spark.createDataFrame(steps, "state int, bit int, filter_order string, step int")

    held = counts.groupBy("part").agg(F.collect_list(F.struct("failed", *COUNTS)).alias("held"))
    listed = ", ".join(f"struct({e.state} AS state, {e.bit} AS bit, {e.orders}L AS weight)" for e in edges)
    taken = held.selectExpr("part", "held", f"inline(array({listed}))")

    def total(name: str, test: str) -> Column:
        return F.expr(f"aggregate(filter(held, h -> {test}), 0L, (a, h) -> a + h.{name})")

    removed = "h.failed & bit <> 0 AND h.failed & state = 0"
    figures = taken.select(
        "part", "state", "bit", "weight",
        total("docs", "h.failed & (state | bit) = 0").alias("kept"),
        total("docs", removed).alias("removed"),
        total("docs", "h.failed & bit <> 0 AND h.failed & state <> 0").alias("redundant"),
        total("docs", "h.failed = bit").alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
    )
    per_filter = Window.partitionBy("part", "bit")  # the edges of one filter
    shares = F.sum(F.col("weight") * F.col("removed")).over(per_filter)
    # Orders times filters, whatever the input: a fixed number of rows.
    found = figures.withColumn("shapley", shares).join(F.broadcast(table), ["state", "bit"])
    return found.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    )


def audit_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Filters A to E over ``docs``, in all 120 orders, per source.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. A null text counts as empty (it fails A), a
    null source as the empty part. Rows given several times count each time and
    are no copies of one another, since none has a smaller doc_id; a row without
    doc_id never fails E. A document is good or toxic where any row of ``labels``
    with its doc_id says so. Texts may have any length; other columns are not
    read; an empty table has no parts and gives no rows.
    """
    return audit(spark, failure_counts(docs, labels))
