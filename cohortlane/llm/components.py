"""Connected components of a graph in tables, by hooking to smaller neighbours and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Steps


def connected_components(edges: DataFrame, steps: Steps, name: str) -> DataFrame:
    """edges (a, b) of longs to (node, root): the least node that each node of an edge reaches.

    Each round every node goes into its least neighbour, if that is smaller, and edges within one node
    vanish; the number of rounds grows with the logarithm of a component's size. Counts and minima are
    combined before each shuffle, so a node with very many edges is no task of its own.
    """
    edges = edges.filter("a <> b").distinct()
    edges = steps.keep(edges, f"{name}_edges_0")
    root: DataFrame | None = None
    n = 0
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        into = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p"))
        into = steps.keep(into, f"{name}_into_{n}")
        if root is None:
            root = into.select(F.col("a").alias("node"), F.col("p").alias("root"))
        else:
            moved = into.select(F.col("a").alias("root"), "p")
            root = root.join(moved, "root", "left").select("node", F.coalesce("p", "root").alias("root"))
            root = steps.keep(root, f"{name}_root_{n}")
        pa, pb = into.select("a", F.col("p").alias("pa")), into.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = edges.join(pa, "a").join(pb, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        edges = steps.keep(moved.filter("a <> b").distinct(), f"{name}_edges_{n + 1}")
        n += 1
    if root is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root
