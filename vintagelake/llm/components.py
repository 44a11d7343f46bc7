"""Connected components of a graph given by its edges, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelake.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node reachable.

    Alternates large-star and small-star rounds: each node hands its larger, then its
    smaller neighbours to the smallest one it knows. The edge set never grows beyond
    its first size, chains halve in each round, and a hub's neighbours are reduced by
    a partial minimum before the shuffle. Lineage is cut after every round.
    edges: u, v; loops and repeats are harmless, nulls are dropped.
    """
    edges = cut(
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _state(edges)
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(
            F.explode(
                F.array(
                    F.struct(F.col("u"), F.col("low").alias("v")),
                    F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                )
            ).alias("e")
        )
        edges = cut(small.select("e.u", "e.v").where("u <> v").distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
