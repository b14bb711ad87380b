"""Connected components of an undirected graph by alternating star contractions.

A large-star step hangs every node's larger neighbours on its smallest one, a
small-star step does so with the smaller ones; after a logarithmic number of
rounds every edge is (node, smallest node of its component).  Each step is a
minimum by node (combined before the exchange, so a node with a third of all
edges is one row per task) and a join back, which Spark splits where a node
is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    least = least.select("node", F.least("node", "m").alias("m"))
    up = both.where("b > a").join(least, F.col("a") == F.col("node"))
    return up.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
    joined = edges.join(least, F.col("a") == F.col("node"))
    return (joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("node").alias("a"), F.col("m").alias("b"))).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; a <> b): root is the smallest reachable node.

    Nodes without edges are not in the result; no edges give an empty one.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "edges")
    before = None
    while True:
        state = _state(edges)
        if state == before or state[0] == 0:
            break
        before = state
        edges = staged(_small_star(_large_star(edges)), "edges")
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(own)
