"""Connected components of a graph given as an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecast.operators.lineage import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every vertex of ``edges`` (``a``, ``b``): the smallest id it can reach.

    Large-star and small-star steps in turn, each an aggregation and a join on the vertex, so no
    neighbourhood is ever collected. Every round is written to the shared folder; the number of
    rounds grows with the logarithm of the longest chain. Loops and repeated edges do no harm; no
    edges give no rows.
    """
    current = materialize(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    state = None
    while True:
        found = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (found.n, found.h) == state or not found.n:
            break
        state = (found.n, found.h)
        around = _both_ways(current)
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = large.filter("a <> b")
        smaller = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        least = smaller.groupBy("u").agg(F.min("v").alias("m"))
        small = smaller.join(least, "u").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b"))
        current = materialize(small.filter("a <> b").distinct())
    roots = current.select(F.col("a").alias("id"), F.col("a").alias("component"))
    return current.groupBy("b").agg(F.min("a").alias("component")).select(F.col("b").alias("id"), "component").unionByName(roots).groupBy("id").agg(F.min("component").alias("component"))
