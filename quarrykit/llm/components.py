"""Connected components of an edge table by rounds of hooking and contraction.

In each round every node hooks to the neighbour of smallest priority, a hash of node and round, if that is
below its own; one pointer jump follows; edges are then rewritten to the new nodes and repeated or closed ones
dropped. Chains of falling random priorities are short, so that few rounds are needed for any shape of
component, paths included, and a star of any size closes in one. Nothing is collected: a round gathers only
whether edges are left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: columns a, b (of a type with an order, as long or binary). Returns node, root for each node that has an edge to another; equal roots, one component.

    Loops and repeated edges don't matter; no edges give no rows."""
    nodes = cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    left, hooks = nodes, []
    while not left.isEmpty():
        rank = lambda c, k=len(hooks): F.xxhash64(F.lit(k), c)
        both = left.select("a", "b").union(left.select(F.col("b"), F.col("a")))
        best = both.groupBy("a").agg(F.min(F.struct(rank(F.col("b")).alias("r"), F.col("b").alias("n"))).alias("m"))
        own = F.struct(rank(F.col("a")).alias("r"), F.col("a").alias("n"))
        once = cut(best.select(F.col("a").alias("node"), F.least("m", own)["n"].alias("to")))
        twice = once.alias("x").join(once.alias("y"), F.col("x.to") == F.col("y.node")).select("x.node", F.col("y.to").alias("to"))
        hook = cut(twice)
        hooks.append(hook)
        for end in ("a", "b"):
            left = left.join(hook.select(F.col("node").alias(end), F.col("to").alias("_to")), end).drop(end).withColumnRenamed("_to", end)
        left = cut(left.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if not hooks:
        return nodes.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = hooks[0].select("node", F.col("to").alias("root"))
    for hook in hooks[1:]:
        found = found.join(hook.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return found
