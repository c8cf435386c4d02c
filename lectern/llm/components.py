"""Connected components of a link table by label hooking and jumping.

Each round hooks the label of every node, and of its current label, to the
smallest label among its neighbours, then replaces labels by their own labels;
the number of rounds grows with the logarithm of the longest chain. Every round
is written to the shared folder. A round has two joins, one that tells the nodes
their neighbours' labels and one that jumps; the rest are counts by key, since
each broadcast or shuffle costs the driver threads and heap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import forget, shared_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the smallest node reachable. Nodes are those of
    the links; a link that repeats or joins a node to itself changes nothing."""
    spark, own, last = links.sparkSession, [], []
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = shared_table(one.unionByName(one.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges", own)
    kind = edges.schema["u"].dataType
    labels = shared_table(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label"))
                          .withColumnRenamed("u", "node"), "labels", last)
    while True:
        # the smallest label among the neighbours of u, then hook u and its label to it
        told = edges.join(labels.select(F.col("node").alias("v"), F.col("label").alias("near")), "v")
        near = (told.select("u", F.lit(None).cast(kind).alias("old"), "near")
                .unionByName(labels.select(F.col("node").alias("u"), F.col("label").alias("old"), F.col("label").alias("near")))
                .groupBy("u").agg(F.min("old").alias("old"), F.min("near").alias("near")))
        own_row = F.struct(F.col("u").alias("node"), F.col("old").alias("old"), F.col("near").alias("label"))
        its_label = F.struct(F.col("old").alias("node"), F.lit(None).cast(kind).alias("old"), F.col("near").alias("label"))
        hooked = (near.select(F.explode(F.array(own_row, its_label)).alias("r")).select("r.*")
                  .groupBy("node").agg(F.min("old").alias("old"), F.min("label").alias("label")))
        old, last = last, []
        hooked = shared_table(hooked, "hooked", old)
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = shared_table(hooked.join(up, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("above", "label")).alias("label")), "jumped", last)
        forget(spark, old)
        changed = jumped.filter("label < old").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            forget(spark, own)
            return labels
