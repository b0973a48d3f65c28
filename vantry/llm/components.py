"""Connected components of large graphs, by joins and sums that are combined before they are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantry.llm.scratch import dropped, written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (its least node) for the nodes of edges (a, b), by alternating large and small stars.

    Each round joins every node with its least neighbour; a hub's rows are split by the engine's skew
    handling, as no step needs them together. Rounds end when the stars no longer change.
    """
    stars = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        old, stars = stars, written(small.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), "edges")
        dropped(old)
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    found = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = written(found.unionByName(found.select(F.col("component").alias("node"), "component").distinct()), "components")
    dropped(stars)
    return out
