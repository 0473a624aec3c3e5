"""Connected components over an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Parts in which the edges of a node with very many of them are joined.
SALTS = 8


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", *, max_rounds: int = 40) -> DataFrame:
    """node, component: the smallest node that each node of ``edges`` reaches.

    Each round links every node's neighbours to the least of them (larger neighbours, then smaller ones), which keeps
    components whole and never makes more edges than there were; it ends when nothing changes. Groups are only
    aggregated by ``min``, never gathered. Nodes without edges aren't listed.
    """

    def with_least(rows: DataFrame, least: DataFrame, key: str, other: str) -> DataFrame:
        """Rows with the least neighbour (m) of their ``key``: edges of a hub are dealt by their other end."""
        part = F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int")
        dealt = least.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
        return rows.withColumn("part", part).join(dealt, [key, "part"])

    edges = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u <> v").distinct()
    edges = cut(edges)
    before = None
    for _ in range(max_rounds):
        # Large star: u's larger neighbours are linked to the least of u and its neighbours.
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = with_least(both.where("v > u"), least, "u", "v").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        # Small star: a node and its smaller neighbours are linked to the least of these.
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = with_least(large, least, "v", "u").select("m", F.explode(F.array("u", "v")).alias("v")).where("m <> v").distinct().toDF("u", "v")
        edges = cut(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    pairs = edges.groupBy("v").agg(F.min("u").alias("component")).select(F.col("v").alias("node"), "component")
    return pairs.union(pairs.select("component", "component").distinct())
