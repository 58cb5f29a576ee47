"""Connected components by alternating large and small stars over an edge table.

Every round is two joins of the edges with a table of one row per node; no node's neighbours are gathered. A node with very many
edges repeats a join key: the table of nodes is dealt anew before the join, so that both sides come by shuffles of their own and
adaptive execution can split that key. Rounds are written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.runtime import stored


def _smallest(edges: DataFrame) -> DataFrame:
    """u, m: the smallest of ``u`` and its neighbours ``v``."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).hint("rebalance")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least.hint("rebalance"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return linked.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (longs u, v) that is not the smallest itself.

    Null ends and loops are no edges; repeated edges count once.
    """
    now = stored(edges.select("u", "v").where("u != v").distinct(), name)
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now)), name)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0
