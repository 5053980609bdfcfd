"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passante.llm.common import written


def _directed(edges: DataFrame) -> DataFrame:
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, settled) of each node: the least of its neighbours and itself, and
    whether it is the least itself or has one neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    nodes = both.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return written(nodes.select("u", F.least("u", "low").alias("m"), F.expr("low > u or low = high").alias("settled")), "cc-least")


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the least of its neighbours and itself.
    Edges may be repeated, but are no more than before."""
    moved = edges.select(F.col("v").alias("u"), F.col("u").alias("larger")).join(least.select("u", "m"), "u")
    return written(moved.select(F.col("larger").alias("u"), F.col("m").alias("v")), "cc-large")


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the least of them."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return written(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (columns u and v of one
    ordered type); a component is named by its least node.

    Least neighbours are found by grouped minima, which are pre-aggregated, and
    written before they are joined back, so that the join can split a hub.
    Every step is written to the shared folder and so done once; the number of
    rounds grows with the logarithm of the number of nodes.  The rounds end when
    each component is a star around its least node: every node is smaller than all
    its neighbours or has only one.  Edges that are stars from the start need no
    round.  No edges give no rows.
    """
    now = written(_directed(edges), "cc-edges")
    for _ in range(rounds):
        least = _least(now)
        if not least.where("not settled").count():
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        now = _small_star(_large_star(now, least))
    raise RuntimeError(f"components are not stable after {rounds} rounds")
