"""Retrieval evaluation (M12): hit@k and reciprocal rank of quote search.

A hit is relevant when its article contains the query passage (the
labelled set of the reference pairs a quote with the url it comes from).
Relevance is checked only on the returned hits, by an equi-join on
article_id, so the evaluation costs as much as the hits, not queries x
articles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def relevance(hits: DataFrame, queries: DataFrame, articles: DataFrame) -> DataFrame:
    """hits (query_id, hit_rank, article_id) -> + relevant."""
    q = queries.select("query_id", F.regexp_replace("query", r"^\s+|\s+\z", "").alias("_q"))
    a = articles.select(F.col("id").alias("article_id"), F.col("body").alias("_b"))
    return (hits.select("query_id", "hit_rank", "article_id").join(q, "query_id").join(a, "article_id")
            .withColumn("relevant", F.instr(F.col("_b"), F.col("_q")) > 0).drop("_q", "_b"))


def eval_hits(hits: DataFrame, queries: DataFrame, articles: DataFrame, k: int = 5) -> DataFrame:
    """Per query: first relevant rank within k (null if none), hit@k, reciprocal rank."""
    r = relevance(hits.where(F.col("hit_rank") <= k), queries, articles)
    first = r.where("relevant").groupBy("query_id").agg(F.min("hit_rank").alias("first_relevant"))
    out = queries.select("query_id").join(first, "query_id", "left")
    return out.select("query_id", F.col("first_relevant").cast("long").alias("first_relevant"),
                      F.col("first_relevant").isNotNull().cast("long").alias("hit_at_k"),
                      F.round(F.coalesce(1.0 / F.col("first_relevant"), F.lit(0.0)), 6).alias("reciprocal_rank"))


def summary(per_query: DataFrame) -> DataFrame:
    return per_query.agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg("hit_at_k"), 6).alias("hit_rate"),
                         F.round(F.avg("reciprocal_rank"), 6).alias("mrr"))


def eval_expected_urls(hits: DataFrame, labelled: DataFrame, k: int = 5) -> DataFrame:
    """The labelled set (query_id, expected_url) against hits (query_id,
    hit_rank, article_url): first rank within k of the expected url, hit@k,
    reciprocal rank. A trailing slash of a url does not matter."""
    def bare(c):
        return F.regexp_replace(F.trim(c), "/+$", "")
    found = (hits.where(F.col("hit_rank") <= k).join(labelled, "query_id")
             .where(bare(F.col("article_url")) == bare(F.col("expected_url")))
             .groupBy("query_id").agg(F.min("hit_rank").cast("long").alias("first_relevant")))
    return labelled.select("query_id").distinct().join(found, "query_id", "left").select(
        "query_id", "first_relevant", F.col("first_relevant").isNotNull().cast("long").alias("hit_at_k"),
        F.round(F.coalesce(1.0 / F.col("first_relevant"), F.lit(0.0)), 6).alias("reciprocal_rank"))
