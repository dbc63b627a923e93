"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .skew import dealt_join
from .storage import discard, materialize


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component): component is the smallest node reachable over undirected edges.

    In each round every node links its larger neighbours to the least of its neighbours and
    itself (large star), then its smaller neighbours and itself to the least of them (small
    star). That keeps what is connected and settles in at most about log² n rounds, however
    nodes are numbered; rounds go on, without a limit, until only stars around least nodes
    are left. Each half round is written to the shared folder. Neighbour minima are
    pre-aggregated before their shuffle, and the edges of a node that has a large share of
    them are dealt over all tasks. Nodes are of any ordered type, structs too. Edges with a
    null end are ignored; an empty edge table gives an empty result.
    """
    e = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).where("s IS NOT NULL AND d IS NOT NULL AND s <> d")
    e = materialize(e.select(F.greatest("s", "d").alias("a"), F.least("s", "d").alias("b")).distinct(), "edges")
    while True:
        ends = e.select(F.col("b").alias("node"), F.col("b").alias("least"), F.lit(0).alias("up"), F.lit(1).alias("down"))
        ends = ends.unionByName(e.select(F.col("a").alias("node"), F.col("b").alias("least"), F.lit(1).alias("up"), F.lit(0).alias("down")))
        nodes = materialize(ends.groupBy("node").agg(F.min("least").alias("least"), F.sum("up").alias("up"), F.sum("down").alias("down")), "nodes")
        if nodes.where("up > 1 OR up > 0 AND down > 0").isEmpty():  # only stars around least nodes
            break
        large = dealt_join(e, nodes.where("down > 0").select("node", "least"), "b", "node", counts=nodes.select(F.col("node").alias("key"), F.col("down").alias("n")))
        large = materialize(large.select("a", F.col("least").alias("b")).distinct(), "large-stars")
        discard(e, nodes)
        least = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("n"))
        least = materialize(least, "least")
        lower = dealt_join(large, least.where("n > 1").select("node", "least"), "a", "node", counts=least.select(F.col("node").alias("key"), "n")).where("b <> least")
        lower = lower.select(F.col("b").alias("a"), F.col("least").alias("b"))
        e = materialize(lower.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct(), "small-stars")
        discard(large, least)
    centres = nodes.where("up = 0").select("node", F.col("node").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
