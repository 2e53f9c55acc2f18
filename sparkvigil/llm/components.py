"""Connected components of a table of edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.session import stage

# A node of more edges than this is joined by broadcast, and so many nodes at most.
HOT_EDGES = 1_000
HOT_NODES = 500_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest node it is joined to.

    Every step writes its edges to the shared folder, so a lost executor only repeats one step. No
    step makes more edges than it read; the steps end when the edges no longer change, which takes
    about the logarithm of the longest path. Where a node has very many edges, such as the centre of a
    star, they stay where they are: what they need to know of it is broadcast.
    """
    current = stage(edges.select("a", "b").filter("a <> b"), "edges")
    seen, many = None, current.count()
    while True:
        # Each edge counts for two nodes, so there are at most HOT_NODES nodes above the limit.
        limit = max(HOT_EDGES, -(-2 * many // HOT_NODES))
        split = limit if many > limit and has_hot(current, limit) else None
        current = stage(small_star(large_star(current, split), split), "edges")
        state = current.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == seen:
            break
        seen, many = state, state["n"]
    # Now every edge joins a node to its root.
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = current.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return roots.union(own).distinct()


def has_hot(edges: DataFrame, limit: int) -> bool:
    """Whether a node has more than ``limit`` edges."""
    nodes = edges.select("a").union(edges.select("b"))
    return not nodes.groupBy("a").count().filter(F.col("count") > limit).isEmpty()


def with_least(rows: DataFrame, least: DataFrame, limit: int | None) -> DataFrame:
    """``rows`` (a, b) with ``m`` of their ``a`` from ``least`` (a, m, n), n being its edges.

    Nodes of more than ``limit`` edges are broadcast; without a limit all go through the exchange.
    """
    if limit is None:
        return rows.join(least.select("a", "m"), "a")
    hot = least.filter(F.col("n") > limit).select("a", F.col("m").alias("hot"))
    cold = least.filter(F.col("n") <= limit).select("a", "m")
    marked = rows.join(F.broadcast(hot), "a", "left")
    near = marked.filter(F.col("hot").isNotNull()).withColumnRenamed("hot", "m")
    return near.unionByName(marked.filter(F.col("hot").isNull()).drop("hot").join(cold, "a"))


def large_star(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Join every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("m", "a"))
    far = with_least(both.filter("b > a"), least, limit).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return far.filter("a <> b").distinct()


def small_star(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Join every smaller-or-equal neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    near = with_least(down, least, limit).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
