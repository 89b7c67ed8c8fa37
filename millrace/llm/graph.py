"""Connected components of a graph that no single machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.llm import common


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for the nodes of edges (``a``, ``b``).

    Every round moves each node onto the first of itself and its neighbours in a hashed order, and keeps the edges
    whose ends went to different nodes, between those and once each. So an edge is joined in the rounds that it
    takes to bring its ends together, and the edges left shrink from round to round. Two rounds share an order: a node with
    many neighbours is done with in two; then a new one is drawn, so that no numbering of the nodes makes the rounds more than
    the logarithm of the longest path, in expectation. The moves are followed from the last round back to the first.
    First neighbours are taken with a map-side part, and joins on a node with many edges are split by adaptive execution.
    Nulls are no nodes; repeated edges count once; without edges there are no rows.
    """
    some = edges.where("a is not null and b is not null")
    links = common.stored(some.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")
    moves, left = [], True
    while left:
        either = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # For whole numbers of 64 bits no two of these hashes are equal.
        best = either.groupBy("a").agg(F.min_by("b", _order("b", len(moves))).alias("best"))
        to = F.when(_order("best", len(moves)) < _order("a", len(moves)), F.col("best")).otherwise(F.col("a"))
        moved = common.stored(best.select(F.col("a").alias("node"), to.alias("to")), "moves")
        moves.append(moved)
        ends = links.join(moved.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        ends = ends.join(moved.select(F.col("node").alias("b"), F.col("to").alias("y")), "b").where("x <> y")
        seen = Observation()
        apart = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        links = common.stored(apart.observe(seen, F.count(F.lit(1)).alias("left")), "links")
        left = seen.get["left"]
    met = moves[-1].select("node", F.col("to").alias("met"))
    for moved in reversed(moves[:-1]):
        met = moved.join(met.withColumnRenamed("node", "to"), "to", "left").select("node", F.coalesce("met", "to").alias("met"))
    met = common.stored(met, "met")
    least = met.groupBy("met").agg(F.min("node").alias("root"))
    return common.stored(met.join(least, "met").select("node", "root"), "roots")


def _order(node: str, done: int):
    return F.xxhash64(node, F.lit(done // 2))
