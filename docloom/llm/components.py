"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.workspace import Workspace


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v). Large: every larger neighbour of u goes to u's smallest; small: every smaller one and u."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m0")).select("u", F.least("u", "m0").alias("m"))
    near = both.join(least, "u")
    if large:
        return near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: one edge a node, and no centre hangs on another."""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("hub")).unionByName(edges.select(F.col("v"), F.lit(0), F.lit(1)).toDF("node", "leaf", "hub"))
    return roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("hub").alias("hub")).filter("leaf > 1 or leaf = 1 and hub = 1").isEmpty()


def components(edges: DataFrame, ws: Workspace, name: str, most: int = 60) -> DataFrame:
    """(node, root) for each node of the edges (u, v) that isn't its component's smallest.

    Each step needs partial aggregates and an equi-join that Spark can split at a hub; no
    node's neighbours are gathered. Edges become stars in a logarithmic number of rounds.
    """
    now = ws.write(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    for i in range(1, most + 1):
        if _settled(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        now = ws.write(_star(_star(now, True), False), f"{name}-{i}")
        ws.drop(f"{name}-{i - 1}")
    raise RuntimeError(f"components did not settle in {most} rounds")
