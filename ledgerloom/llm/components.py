"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import stage


def connected(edges: DataFrame) -> DataFrame:
    """``node, component``: for each node of the edges ``a, b`` (long) the smallest node that it reaches.

    Each round sends every node to the node of lowest random rank within two steps, relabels the edges by it and drops
    those that became loops. The number of nodes falls by a factor each round, whatever the shape (long chains, stars),
    and only edges between different nodes are left to the next one. Null ends and loops are ignored; an empty
    table gives an empty result. All state is in tables below the shared folder; the driver sees one flag per round.
    Joins have a stored table on both sides, so that the adaptive planner splits a hub's partition.
    """
    live = stage(edges.select("a", "b").filter("a is not null and b is not null and a <> b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not live.isEmpty():
        turn = F.lit(len(moves))
        near = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = near.union(near.select("a", F.col("a").alias("b")))
        first = near.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", turn).alias("rank"), F.col("b").alias("node"))).alias("best"))
        first = stage(first, "first")
        second = near.join(first.select(F.col("a").alias("b"), "best"), "b").groupBy("a").agg(F.min("best").alias("best"))
        move = stage(second.select(F.col("a").alias("node"), F.col("best.node").alias("to")), "move")
        to_a, to_b = move.toDF("a", "to_a"), move.toDF("b", "to_b")
        moved = live.join(to_a, "a").join(to_b, "b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        live = stage(moved.filter("a <> b").distinct(), "edges")
        moves.append(move)
    if not moves:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = moves.pop()
    while moves:
        later = root.toDF("to", "root")
        root = moves.pop().join(later, "to", "left").select("node", F.coalesce("root", "to").alias("to"))
    root = stage(root, "roots")
    least = stage(root.groupBy("to").agg(F.min("node").alias("component")), "least")
    return root.join(least, "to").select("node", "component")
