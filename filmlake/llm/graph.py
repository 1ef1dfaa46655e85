"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlake.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: long): root is the least node it can reach.

    Each round connects every node's larger neighbours, and then its smaller ones, to its least
    neighbour, and writes the edges; it ends when the edges no longer change, after a number of
    rounds that grows with the logarithm of the longest chain. Loops, repeated edges and either
    direction are allowed; no edges give no rows.
    """
    now = materialize(
        edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
        .filter("x <> y")
        .distinct(),
        "edges",
    )
    before, state = None, _state(now)
    while state != before and state[0]:
        both = now.union(now.select("y", "x")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        centre = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(centre, "x").select(F.explode(F.array(
            F.struct("x", F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y"))
        )).alias("e")).select("e.*")
        now = materialize(small.filter("x <> y").distinct(), "edges")
        before, state = state, _state(now)
    nodes = now.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return nodes.union(now.select("y", "y").distinct())


def _state(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())
