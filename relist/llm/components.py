"""Connected components of an edge table, by alternating stars.

Large star: every node hands its larger neighbours to its smallest one.
Small star: every node hands its smaller neighbours and itself to the
smallest.  Both keep the components; after a number of rounds that grows
with the logarithm of the largest one only stars are left.  Each round is
written to the shared folder, so lineage stays short and lost executors only
repeat tasks of one round.  Only whether all edges are stars reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _settled(e: DataFrame) -> bool:
    """Whether the edges (u > v) are stars: every u has one v, which is no u."""
    ups = e.groupBy("u").agg(F.count("*").alias("n"), F.min("v").alias("v"))
    chained = ups.join(ups.select(F.col("u").alias("v")), "v", "left_semi")
    return ups.where("n > 1").select("u").unionByName(chained.select("u")).isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` can
    reach.  Self-loops and null ends are ignored; repeated edges are harmless."""
    e = materialise(edges.where(F.col(a) != F.col(b))
                    .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = materialise(small, "stars", past=[e])
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
