"""Connected components in Spark: alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retaloom.llm.common import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star round over edges (u, v), u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u <> v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(least, "u")
    return (
        joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of the edges (a, b).

    Rounds end when the edges no longer change; then every edge leads to the smallest node
    of its component, which itself is listed too. Each round is stored, so lineage
    stays short. A node with very many edges meets one row in each join, so its
    partition can be split.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "edges")
    mark = lambda df: tuple(df.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(now)
    while before[0]:
        now = stored(_stars(now), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(now.select("v", "v")).distinct()
