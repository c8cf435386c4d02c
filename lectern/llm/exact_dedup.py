"""Exact dedup by progressive refinement: length, prefix hash, full hash.

Each level only passes on what may still have an equal. The groups of a level
are counted with map-side aggregation and turned into a sieve of fixed size,
so rows that are alone at some level leave without being shuffled and without
having their whole text hashed; only survivors are hashed in full and grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import mark_in_sieve, prepare, shared_table, sieve_rows, sieve_slot

LENGTH_BITS = 22           # lengths from 4 MB on share one slot and so always go on together
PREFIX_CHARS = 64
OUTPUT = ("keep_id", "group_size", "kept")


def _frozen(rows: DataFrame) -> DataFrame:
    """The sieve as a local table of at most 2**26 bits."""
    return rows.sparkSession.createDataFrame(rows.collect(), "part long, bitmap binary")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """All rows and columns of ``docs`` with keep_id, group_size and kept.

    Texts are equal when identical; the row with the largest id stays. A null
    text is empty. An empty table gives no rows. Rows that share id and text
    are counted in group_size and share the decision. A null id never wins
    over another id; where a group has null ids only, they stay. Input columns
    named like an output column are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop(*OUTPUT)
    body = F.coalesce(F.col(text_col), F.lit(""))
    length = F.octet_length(body)
    length_slot = F.least(length, F.lit((1 << LENGTH_BITS) - 1)).cast("long")

    lengths = docs.groupBy(length_slot.alias("s")).count().filter("count > 1")
    by_length = _frozen(sieve_rows(lengths, "s"))
    level1 = mark_in_sieve(docs, length_slot, by_length, "__l1")

    prefix_slot = sieve_slot(F.xxhash64(length, F.substring(body, 1, prefix_chars)))
    prefixes = (level1.filter("__l1").groupBy(prefix_slot.alias("s")).count().filter("count > 1"))
    by_prefix = _frozen(sieve_rows(prefixes, "s"))
    level2 = mark_in_sieve(level1, F.when(F.col("__l1"), prefix_slot), by_prefix, "__l2").drop("__l1")

    alone = (level2.filter(~F.col("__l2")).drop("__l2")
             .withColumn("keep_id", F.col(id_col)).withColumn("group_size", F.lit(1).cast("long")))
    rest = level2.filter("__l2").drop("__l2").withColumn("__sha", F.sha2(body.cast("binary"), 256))
    groups = shared_table(
        rest.groupBy("__sha").agg(F.max(id_col).alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1"), "groups")
    # a plain join of two shuffled sides: adaptive execution splits the rows of a large group
    grouped = (rest.join(groups, "__sha", "left").drop("__sha")
               .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id")))
               .withColumn("group_size", F.coalesce("group_size", F.lit(1).cast("long"))))
    return (alone.unionByName(grouped)
            .withColumn("kept", F.col("keep_id").eqNullSafe(F.col(id_col))))
