"""Connected components over an edge table.

Alternating large-star and small-star steps (Kiveris et al., 2014): each is one
aggregation and one join, so no node's neighbours are gathered in a task, and the
number of steps grows with the logarithm of the graph. Each step's edges are
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ohmbridge.storage import materialize, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id on an edge: the least id that it reaches."""
    x, y = F.col(a), F.col(b)
    e = edges.where(x.isNotNull() & y.isNotNull() & (x != y)).select(F.greatest(x, y).alias("hi"), F.least(x, y).alias("lo")).distinct()
    e = materialize(e, "graph")
    seen = None
    while True:
        sides = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = sides.groupBy("hi").agg(F.least(F.min("lo"), F.first("hi")).alias("root"))
        up = sides.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("root").alias("lo")).distinct()
        root = up.groupBy("hi").agg(F.min("lo").alias("root"))
        down = up.join(root, "hi").where("lo <> root").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
        before, e = e, materialize(down.unionByName(root.select("hi", F.col("root").alias("lo"))).distinct(), "graph")
        release(before)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    return e.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(e.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())


def with_components(nodes: DataFrame, edges: DataFrame, node: str = "id") -> DataFrame:
    """``nodes`` with ``component``; a node without edges is its own."""
    comp = connected_components(edges).select(F.col("id").alias("__node"), "component")
    return nodes.join(comp, nodes[node] == F.col("__node"), "left").withColumn("component", F.coalesce("component", node)).drop("__node")
