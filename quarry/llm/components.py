"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import materialise


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of an edge ``u, v`` (longs); root is the smallest node that it reaches.

    Alternating large-star and small-star steps: each joins the edges with the smallest neighbour of their nodes, so
    the links of a node meet only in a partial aggregate. The rounds grow with the logarithm of the size; each
    writes its edges to the shared folder. Self-loops and repeated edges are allowed; null ends are left out.
    """
    edges = materialise(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # each edge now points to a smaller node
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = materialise(small, "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
