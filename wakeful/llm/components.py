"""Connected components of a large graph by alternating star contraction.

Each round replaces the edges by stars around smaller nodes (once towards the
larger neighbours, once towards the smaller ones) until nothing changes; rounds grow
with the logarithm of the longest path. All steps are joins on min-aggregates, so a
node with very many edges is pre-aggregated on the map side and its join partition
can be split by adaptive execution. Every round is a written table: lost executors
recompute one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeful.llm.common import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Edges (``a``, ``b``) -> (``node``, ``root``), root the smallest node of the
    component; one row per node that is not its own root. Self-loops, repeated edges
    and nulls are ignored; no edges give no rows."""
    state = cut_lineage(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        "edges",
    )
    seen = _digest(state)
    while seen[0]:
        state = cut_lineage(_small_star(_large_star(state)), "edges")
        now = _digest(state)
        if now == seen:
            break
        seen = now
    return state.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
        edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % F.lit(1 << 40))).first()
    return tuple(row)
