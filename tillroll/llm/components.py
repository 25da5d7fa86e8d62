"""Connected components of an edge table, by alternating large-star and small-star
steps (Kiveris et al., "Connected Components in MapReduce and Beyond")."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored


def _minima(pairs: DataFrame) -> DataFrame:
    # stored, so that the join that follows deals both its sides and can split a hub
    return stored(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "minima")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns); the component
    is its smallest node. Self-loops and repeated edges are allowed; a null end
    drops the edge; no edges give an empty table."""
    a, b = edges.columns[:2]
    star = stored(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "star")
    nodes = star
    before = None
    while True:
        both = star.union(star.select("v", "u"))
        large = both.join(_minima(both), "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        small = large.join(_minima(large), "u")
        star = stored(small.select("u", F.col("m").alias("v")).union(
            small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(),
            "star")
        state = star.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before:
            break
        before = state
    roots = nodes.select(F.col("u").alias("node")).union(nodes.select("v")).distinct()
    found = star.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.join(found, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
