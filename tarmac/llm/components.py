"""Connected components by alternating large-star and small-star steps.

Each step replaces the edges of a node by edges to the least node it knows; the number of
steps grows with the logarithm of the longest chain. Only edges between different nodes are
held, every minimum is pre-aggregated before the shuffle, and the edges are written to the
shared folder after each round, so neither the driver nor one task holds a component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import save


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not larger:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is its least node."""
    edges = edges.select("u", "v").where("u <> v")
    before = None
    while True:
        edges = save(_star(_star(edges, True), False), "edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == before:
            break
        before = state["n"], state["s"]
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
