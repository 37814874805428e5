"""Connected components of an undirected graph, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from forumlens.operators.lookup import lookup_join
from forumlens.session import BROADCAST_ROWS, materialise


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``node, root`` for each node of an edge table ``a, b``; root is the least node reachable.

    Each round hangs every node below its least neighbour if that is smaller, follows these
    parents to the top by doubling, and puts the tops in place of the nodes in all edges. What
    joins a top with itself is dropped and equal edges are merged, so that the graph shrinks
    until no edge is left. Every table is written, and no node's neighbours are gathered: a
    node with very many edges is aggregated partially, and joined to one row.

    ``known`` is what this function returned for other edges, which then count as well: only what
    the edges join anew is worked on. Each query stays in the driver's memory for a while, as its
    plan, threads and generated code, so that a round starts few, however small its tables are.

    Edges with a null end and loops count as nothing. No edges: no rows but the known ones.
    """
    if known is not None and (n := known.count()):
        edges = _replaced(_replaced(edges.select("a", "b"), "a", known, n), "b", known, n)
    left = materialise(_proper(edges), "edges")
    roots, done = known, left.isEmpty()
    if known is None and done:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if known is not None and not done:
        nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        fresh = nodes.join(known, "node", "left_anti")
        roots = known.unionByName(fresh.select("node", F.col("node").alias("root")))
    while not done:
        both = left.union(left.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("root")
        )
        parents = materialise(parents, "parents")
        n = parents.count()
        parents = _tops(parents, n)
        roots = parents if roots is None else materialise(_replaced(roots, "root", parents, n), "roots")
        left = materialise(_proper(_replaced(_replaced(left, "a", parents, n), "b", parents, n)), "edges")
        done = left.isEmpty()
    return roots


def _proper(edges: DataFrame) -> DataFrame:
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.filter(F.col("a") != F.col("b")).select(least, most).distinct()


def _tops(parents: DataFrame, n: int) -> DataFrame:
    """Each node's topmost parent; ``n`` is the number of nodes."""
    while True:
        last = parents.withColumn("_last", F.col("root"))
        twice = _replaced(_replaced(last, "root", parents, n), "root", parents, n)
        joined = materialise(twice.withColumn("_moved", F.col("root") != F.col("_last")), "tops")
        parents = joined.select("node", "root")
        if joined.filter("_moved").isEmpty():
            return parents


def _replaced(df: DataFrame, column: str, roots: DataFrame, n: int) -> DataFrame:
    """``df`` with the tops of its nodes in ``column``; ``roots`` has ``n`` rows.

    A node may have most of the edges, or be the top of most nodes: beyond what is broadcast whole,
    its weight is counted, and the join splits it off.
    """
    above = roots.select(F.col("node").alias("_node"), F.col("root").alias("_top"))
    if n > BROADCAST_ROWS:
        weights = df.groupBy(F.col(column).alias("_node")).agg(F.count("*").alias("_weight"))
        above, n = materialise(above.join(weights, "_node"), "tops"), None
    else:
        above = above.withColumn("_weight", F.lit(1))
    joined = lookup_join(df, above, column, "_node", "_weight", count=n)
    return joined.withColumn(column, F.coalesce("_top", column)).drop("_top").select(df.columns)
