"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.tables import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` with the smallest node of each component as root.

    ``edges`` has the long columns ``a`` and ``b``, without nulls. Every round
    hangs each node on the smallest node known in its neighbourhood and is
    written as a table. Large stars and small stars take turns, so that the
    number of rounds grows with the logarithm of a component and no node
    gathers its neighbours in memory. Only nodes with edges are returned.
    """
    pairs = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        # Large star: larger neighbours of a node move to its smallest one.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        # Small star: a node and its smaller neighbours move to the smallest.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = (
            moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).unionByName(low.select("u", F.col("m").alias("v")))
        pairs = stored(small.distinct(), "edges")
        now = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    own = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(own)
