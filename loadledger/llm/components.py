"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadledger.llm.tables import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node to the least of them.

    The large star moves greater neighbours, the small star the lesser ones and
    the node itself. Least neighbours are aggregated before they meet the
    edges, so a node with very many neighbours is never gathered.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("low", "u").alias("low"))
    met = both.join(least, "u")
    if large:
        moved = met.filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        moved = met.select(F.col("v").alias("u"), F.col("low").alias("v"))
        moved = moved.unionByName(least.select("u", F.col("low").alias("v")))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): the least node that it can reach.

    Each round is written to the shared folder, so the plan stays short and a
    lost executor costs no earlier round. Rounds grow with the logarithm of the
    longest path.
    """
    state = stage(edges.filter("u <> v").select("u", "v").distinct(), "components")
    mark = None
    while True:
        now = state.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("digest")
        ).first()
        if now["n"] == 0 or mark == (now["n"], now["digest"]):
            break
        mark = (now["n"], now["digest"])
        state = stage(_star(_star(state, True), False), "components")
    roots = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
