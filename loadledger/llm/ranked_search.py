"""Ranked search over pipelined term owners.

The terms of the query items are dealt to a few owners, rarest first. A bundle
of an item carries its terms and a sparse list of accumulators, one per document
that has scored so far, from owner to owner: each stage cogroups the bundles
with the postings of its owner and adds integer contributions. What leaves the
last stage are the best of every bundle, from which the best of all are chosen.

A bundle covers one shard of the documents, so neither its accumulators nor the
postings it meets grow with the corpus. Once a bundle holds ``k`` scores, a
document that could not reach the least of them with everything that later
owners may add leaves the bundle; the bound is never too low, so results are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from loadledger.llm.tables import stage

# What separates terms, and the constants of the score.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_LENGTH, LENGTH_SHARE = 10, 90
MOST_PER_WEIGHT = 1_000_000  # a term adds less than this times its weight
OWNERS = 4
SHARD_DOCS = 8192  # documents of a shard, about
EVERY = -1  # the number of the empty term, which every document holds
BLOCK_ITEMS = 4096  # items whose bundles go through the owners together

BUNDLE = "shard long, iid long, terms binary, rids binary, ids binary, scores binary"
BEST = "iid long, rid long, score long"
TERM = np.dtype([("tid", "<i8"), ("w", "<i8"), ("owner", "<i4")])


def terms_of(text: Column) -> Column:
    """Terms of a text in order, A-Z in lower case; none for null."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), CAPITALS, CAPITALS.lower())
    return F.array_remove(F.split(lower, SEPARATORS), "")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each term of an item once."""
    each = F.explode(terms_of(F.col("text"))).alias("term")
    return items.select(F.col("item_id").cast("long").alias("item_id"), each).distinct()


def postings_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(rid, doc_id, n, tid, tf): how often each document holds each of the terms (tid, term).

    Every document also holds the empty term once, if that is asked for, so that
    the counts over all documents come from the same single pass.
    """
    read = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("long").alias("doc_id"),
        terms_of(F.col("text")).alias("terms"),
    )
    tokens = read.select(
        "rid",
        "doc_id",
        F.size("terms").cast("long").alias("n"),
        F.explode(F.concat("terms", F.array(F.lit("")))).alias("term"),
    )
    found = tokens.join(terms, "term")
    return found.groupBy("rid", "doc_id", "n", "tid").agg(F.count(F.lit(1)).alias("tf"))


def weighted(postings: DataFrame, holders: int, owners: int) -> DataFrame:
    """(tid, w, owner) of the terms that occur: the weight, and the owner by rarity."""
    counts = postings.filter(F.col("tid") != EVERY).groupBy("tid").agg(F.count(F.lit(1)).alias("df"))
    counts = stage(counts, "terms")
    cuts = [n / owners for n in range(1, owners)]
    at = counts.agg(F.percentile_approx("df", cuts).alias("at")).first()["at"] or []
    owner = sum((F.when(F.col("df") > cut, 1).otherwise(0) for cut in at), F.lit(0))
    w = F.floor(1000.0 * F.log((2.0 * holders + 2) / (2.0 * F.col("df") + 1)))
    return counts.select("tid", w.cast("long").alias("w"), owner.cast("int").alias("owner"))


class _Postings:
    """The postings of a shard and an owner, in the order of their terms."""

    def __init__(self, rows: pd.DataFrame) -> None:
        order = np.argsort(rows["tid"].to_numpy(np.int64), kind="stable")
        names = ("tid", "rid", "doc_id", "tf", "m")
        self.tid, self.rid, self.doc_id, tf, m = (rows[n].to_numpy(np.int64)[order] for n in names)
        self.parts = (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def scored(self, terms: np.ndarray) -> "_Scores":
        """What the terms add to the documents that hold them."""
        starts = np.searchsorted(self.tid, terms["tid"], "left")
        ends = np.searchsorted(self.tid, terms["tid"], "right")
        at = np.concatenate([np.arange(a, b) for a, b in zip(starts, ends)])
        adds = np.repeat(terms["w"], ends - starts) * self.parts[at]
        return _summed(self.rid[at], self.doc_id[at], adds)


_Scores = tuple[np.ndarray, np.ndarray, np.ndarray]  # rid, doc_id, score


def _summed(rid: np.ndarray, doc_id: np.ndarray, scores: np.ndarray) -> _Scores:
    """One accumulator per document."""
    every, first, at = np.unique(rid, return_index=True, return_inverse=True)
    sums = np.zeros(len(every), np.int64)
    np.add.at(sums, at, scores)
    return every, doc_id[first], sums


def _within_reach(scores: np.ndarray, rest: int, k: int) -> np.ndarray:
    """Which accumulators can still come among the ``k`` best; equal scores can."""
    if len(scores) <= k:
        return np.ones(len(scores), bool)
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    return scores + rest >= least


def _opened(bundle: tuple) -> _Scores:
    return tuple(np.frombuffer(column, "<i8") for column in (bundle.rids, bundle.ids, bundle.scores))


def add_owner(owner: int, k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One stage: the bundles of a shard with what the owner's postings add."""

    def add(bundles: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        postings, found = _Postings(rows), []
        for bundle in bundles.itertuples(index=False):
            terms, held = np.frombuffer(bundle.terms, TERM), _opened(bundle)
            here = terms[terms["owner"] == owner]
            if len(here) and len(rows):
                more = postings.scored(here)
                held = _summed(*(np.concatenate(pair) for pair in zip(held, more)))
                rest = MOST_PER_WEIGHT * int(terms["w"][terms["owner"] > owner].sum())
                kept = _within_reach(held[2], rest, k)
                held = tuple(column[kept] for column in held)
            found.append((bundle.shard, bundle.iid, bundle.terms, *(column.tobytes() for column in held)))
        return pd.DataFrame(found, columns=[c.split()[0] for c in BUNDLE.split(", ")])

    return add


def best_of(k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The ``k`` best of each bundle as rows; equal scores by ascending doc_id."""

    def best(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for bundle in part.itertuples(index=False):
                rids, ids, scores = _opened(bundle)
                order = np.lexsort((rids, ids, -scores))[:k]
                order = order[scores[order] > 0]
                yield pd.DataFrame({"iid": bundle.iid, "rid": rids[order], "score": scores[order]})

    return best


def _bundles(weights: DataFrame, pairs: DataFrame, shards: int) -> DataFrame:
    """An empty bundle of every item for every shard, with the item's terms."""

    def packed(terms: pd.DataFrame) -> pd.DataFrame:
        held = terms[["tid", "w", "owner"]].sort_values("tid").to_records(index=False).astype(TERM)
        return pd.DataFrame([(terms["iid"].iloc[0], held.tobytes())], columns=["iid", "terms"])

    per_item = pairs.join(weights, "tid").groupBy("iid").applyInPandas(packed, "iid long, terms binary")
    empty = F.lit(b"")
    return per_item.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        "iid", "terms", empty.alias("rids"), empty.alias("ids"), empty.alias("scores"),
    )


def search(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    owners: int = OWNERS,
    shard_docs: int = SHARD_DOCS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 of each item.

    Equal scores rank by ascending doc_id, null ones last. Every row of ``docs``
    is a document, also where it is given several times; rows of ``items`` with one
    item_id, null among them, are one item with the terms of all. Null and empty
    texts hold no terms, and texts may have any length. Where either table is
    empty there are no rows. Columns other than doc_id, item_id and text are not read.
    """
    pairs = stage(item_terms(items), "items")
    numbered = F.monotonically_increasing_id()
    ids = stage(pairs.select("item_id").distinct().select(numbered.alias("iid"), "item_id"), "item-ids")
    empty = spark.range(1).select(F.lit(EVERY).cast("long").alias("tid"), F.lit("").alias("term"))
    terms = pairs.select("term").distinct().select(numbered.alias("tid"), "term")
    terms = stage(terms.unionByName(empty), "query-terms")
    asked = pairs.join(ids, pairs["item_id"].eqNullSafe(ids["item_id"])).join(terms, "term")
    asked = stage(asked.select("iid", "tid"), "asked")

    postings = stage(postings_of(docs, terms), "postings")
    every = postings.filter(F.col("tid") == EVERY)
    total = every.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("n") > 0).alias("holders"), F.sum("n").alias("length")
    ).first()
    blocks = -(-ids.count() // block_items)
    if not total["length"] or not blocks:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    weights = stage(weighted(postings, total["holders"], owners), "weights")

    shards = -(-total["rows"] // shard_docs)
    shard = F.pmod(F.xxhash64("rid"), F.lit(shards).cast("long")).alias("shard")
    m = F.expr(f"{LEAST_LENGTH}L + ({LENGTH_SHARE}L * n * {total['holders']}L) div {total['length']}L")
    # A null doc_id comes after all others.
    doc_id = F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id")
    dealt = postings.join(weights, "tid").select(shard, "owner", "rid", doc_id, "tid", "tf", m.alias("m"))
    dealt = stage(dealt, "dealt")
    block = F.pmod(F.xxhash64("iid"), F.lit(blocks).cast("long"))
    best: DataFrame | None = None
    for number in range(blocks):
        bundles = _bundles(weights, asked.filter(block == number), shards)
        for owner in range(owners):
            held = dealt.filter(F.col("owner") == owner).drop("owner")
            grouped = bundles.groupBy("shard").cogroup(held.groupBy("shard"))
            bundles = grouped.applyInPandas(add_owner(owner, k), BUNDLE)
        found = bundles.mapInPandas(best_of(k), BEST)
        best = found if best is None else best.unionByName(found)

    documents = every.select("rid", "doc_id")
    order = Window.partitionBy("iid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "rid")
    ranked = stage(best, "best").join(documents, "rid").withColumn("rank", F.row_number().over(order))
    top = ranked.filter(F.col("rank") <= k)
    return top.join(ids, "iid").select("item_id", "rank", "doc_id", "score")

