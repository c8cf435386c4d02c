"""Dense ids in key order without a single-partition window.

A global ``row_number() over (order by key)`` pulls every row into one
task. Instead the distinct keys, and nothing else, are range-partitioned and
written once; partition sizes, offsets and ranks are all read from that one
written table. (A range partitioning samples its bounds, so evaluating it twice
could give two different partitionings.) The ids are joined back by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import written


def key_ids(keys: DataFrame, order_col: str, id_col: str = "id", start: int = 1) -> DataFrame:
    """(order_col, id_col): one dense id per distinct non-null key, in key order."""
    spark = keys.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(
        keys.select(order_col).where(F.col(order_col).isNotNull()).distinct()
        .repartitionByRange(n, order_col).withColumn("_pid", F.spark_partition_id()), "key_ids")
    # one row per partition, not per key
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_pid").count().select(
        "_pid", F.coalesce(F.sum("count").over(w), F.lit(0)).alias("_off"))
    rank = F.row_number().over(Window.partitionBy("_pid").orderBy(order_col))
    return (ranged.withColumn("_rn", rank).join(offsets, "_pid")
            .select(order_col, (F.col("_off") + F.col("_rn") + (start - 1)).cast("long").alias(id_col)))


def dense_ids(df: DataFrame, order_col: str, id_col: str = "id", start: int = 1) -> DataFrame:
    """Rows of ``df`` with the id of their key; equal keys share an id, a null
    key has none."""
    return df.join(key_ids(df, order_col, id_col, start), order_col, "left").select(*df.columns, id_col)
