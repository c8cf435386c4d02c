"""Vector aggregates and views (A1, G5, M7 centroids, W1 on the vectors table).

Mean pooling uses ``Summarizer.mean`` over ML vectors: a JVM aggregate
with partial (map-side) buffers, so chunk vectors of an article never need
to meet in one place and nothing is exploded per dimension.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.config import RETRIEVAL_CANDIDATES
from lectern.operators.shortlist import shortlist


def explode_vector(df: DataFrame, key_cols: list[str], vec_col: str = "embedding",
                   nonzero: bool = True) -> DataFrame:
    """(keys..., dim, value) rows; zeros dropped when ``nonzero``."""
    out = df.select(*key_cols, F.posexplode(vec_col).alias("dim", "value"))
    out = out.withColumn("value", F.col("value").cast("double"))
    return out.where(F.col("value") != 0) if nonzero else out


def mean_pool(chunk_vectors: DataFrame, key: str = "article_id", vec_col: str = "embedding",
              carry: tuple[str, ...] = (), check: bool = False) -> DataFrame:
    """A1: mean of chunk vectors per article, computed in double, stored float32.

    ``carry`` columns must be constant per article: one value is kept, and with
    ``check`` an article with several titles is an error (V11).
    """
    if check and "title" in carry:
        from lectern.operators.quality import require, title_violations
        require(title_violations(chunk_vectors.withColumnRenamed(key, "article_id")), "chunk titles")
    v = chunk_vectors.withColumn("_v", array_to_vector(F.col(vec_col)))
    aggs = [Summarizer.mean(F.col("_v")).alias("_m")] + [F.first(c).alias(c) for c in carry]
    pooled = v.groupBy(key).agg(*aggs)
    return pooled.select(key, *carry, vector_to_array("_m", "float32").alias(vec_col))


def centroids(vectors: DataFrame, label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per label (double), as (label, embedding)."""
    v = vectors.withColumn("_v", array_to_vector(F.col(vec_col)))
    c = v.groupBy(label_col).agg(Summarizer.mean(F.col("_v")).alias("_m"))
    return c.select(F.col(label_col), vector_to_array("_m", "float64").alias(vec_col))


def vector_topk(vectors: DataFrame, k: int = RETRIEVAL_CANDIDATES, id_col: str = "vec_id",
                label_col: str = "label") -> DataFrame:
    """Top-k vectors nearest each label's centroid: representative documents.

    Queries are the centroids, one per label, so the query side is bounded
    by the number of topics."""
    cents = centroids(vectors.where(F.col(label_col).isNotNull()), label_col).select(
        F.col(label_col).cast("long").alias("query_id"), "embedding")
    return shortlist(cents, vectors.select(id_col, "embedding"), k=k, id_cols=(id_col,)).select(
        F.col("query_id").alias(label_col), id_col, "score", "rank")
