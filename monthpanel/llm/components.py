"""Connected components by contraction, all in DataFrame operations.

Each round every node takes its smallest neighbour as parent, parents are shortened until they are roots, and the edges are
drawn anew between roots; the rounds end when no edge is left. Parents are always smaller, so the last root is the smallest node of its
component. Each step is a stored table, sums and minima are partial, and joins are between stored tables, which adaptive
execution splits where a third of the nodes has one root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthpanel.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; ``component`` is the smallest node that it reaches."""
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    roots = None
    while True:
        ends = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up")).withColumn("up", F.least("node", "up")), "up")
        while True:
            above = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
            up = stored(up.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "up")
            moved = up.where("moved").limit(1).count()
            up = up.drop("moved")
            if not moved:
                break
        if roots is None:
            roots = up.withColumnRenamed("up", "component")
        else:
            lifted = up.select(F.col("node").alias("component"), "up")
            roots = stored(
                roots.join(lifted, "component", "left").select("node", F.coalesce("up", "component").alias("component")), "roots"
            )
        a = up.select(F.col("node").alias("a"), F.col("up").alias("_a"))
        b = up.select(F.col("node").alias("b"), F.col("up").alias("_b"))
        edges = stored(
            edges.join(a, "a").join(b, "b").where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct(), "edges"
        )
        if not edges.limit(1).count():
            return roots
