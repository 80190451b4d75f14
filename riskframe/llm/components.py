"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.sources.tables import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its smallest node.

    Alternating star contraction: every node points its larger neighbours to its
    smallest one, then its smaller neighbours and itself. The number of links never
    grows and each round halves the depth. Each round starts from a written table.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), "links")
    state = _state(edges)
    for _ in range(rounds):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stored(small, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
