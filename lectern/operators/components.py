"""Connected components by alternating stars.

In a large star every node points its larger neighbours to its smallest one; in
a small star it points itself and its smaller neighbours there. Both keep the
components, and repeating them leaves one star around the smallest node of each.
Every step is an aggregation that combines map-side and a join, so a node with
very many neighbours is never gathered. Each round's edges are written, the
round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import discard, written

MAX_ROUNDS = 64


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger to the smaller node."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    there = edges.join(least, "u")
    return (there.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): every node of a link with the smallest node of its component.

    Links of a node to itself only name it; null ends are ignored."""
    spark = links.sparkSession
    known = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    scratch: list[str] = []
    nodes = written(known.select(F.col(a).alias("node")).union(known.select(F.col(b))).distinct(), "component_nodes")
    edges = written(known.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                    "component_edges", scratch)
    seen = None
    for _ in range(MAX_ROUNDS):
        before = list(scratch)
        edges = written(_small_star(written(_large_star(edges), "large_star", scratch)), "small_star", scratch)
        shape = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        discard(spark, before)
        scratch = scratch[len(before):]
        if shape == seen:
            break
        seen = shape
    else:
        raise RuntimeError(f"components have not settled after {MAX_ROUNDS} rounds")
    return nodes.join(edges.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("label"))
