"""The corpus artifacts every query builds on, derived from the input tables.

raw articles -> non-blank scan (S2) -> chunks (G1) -> chunk vectors (M1,
remapped to position/text as the serving table, P9). Serving articles are
the raw articles loaded with the loader's rules (P6, P7) plus a topic from
the matching vector's label (-1 when none).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import content_hash, parse_published_at
from lectern.operators.chunk import chunk_articles
from lectern.operators.encode import encode_chunks
from lectern.sources.tables import article_view, topic_of_article


# Tone words of the registered queries, words that occur in the
# input texts (the default lists are plain English, which those texts are not).
TONE_WORDS = {
    "academic": ("thtion", "ertion", "attion", "antion", "ontion", "thintion", "oution"),
    "militant": ("idiot", "stupid", "worthless", "pathetic", "clown"),
    "hopeful": ("thanea", "eriner", "thndly", "onlyhe", "enlich", "être"),
    "critical": ("enheit", "enkeit", "thanedble", "thedre", "the", "der"),
}

# Seeds from which the registered queries learn further tone words.
TONE_SEEDS = {label: words[:2] for label, words in TONE_WORDS.items()}


def scan_nonblank(articles: DataFrame) -> DataFrame:
    """Drop rows whose text is null or only spaces (SQL trim)."""
    return articles.where(F.col("text").isNotNull() & (F.trim(F.col("text")) != ""))


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_nonblank(article_view(spark, sf_dir))


def chunks(spark: SparkSession, sf_dir: str, of: DataFrame | None = None) -> DataFrame:
    """Chunks of all articles, or of those whose article_id is in ``of``."""
    raw = raw_articles(spark, sf_dir).select("article_id", "title", "text")
    if of is not None:
        raw = raw.join(of.select("article_id"), "article_id", "left_semi")
    return chunk_articles(raw)


def remap_chunks(chunked: DataFrame) -> DataFrame:
    """Idx -> position, chunk_text -> text, title dropped."""
    cols = ["article_id", F.col("idx").alias("position"), F.col("chunk_text").alias("text")]
    if "embedding" in chunked.columns:
        cols.append("embedding")
    return chunked.select(*cols)


def chunk_vectors(spark: SparkSession, sf_dir: str, encoder_factory=None, of: DataFrame | None = None) -> DataFrame:
    return remap_chunks(encode_chunks(chunks(spark, sf_dir, of), encoder_factory))


def serving_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded rows with their topic. All columns are made before the join, so
    that a reader who drops the body joins rows without it."""
    a = raw_articles(spark, sf_dir)
    rows = a.select(
        F.col("article_id").alias("id"),
        F.trim(F.col("url")).alias("url"),
        content_hash(F.col("text")).alias("content_hash"),
        F.col("title"), F.col("author"),
        parse_published_at(F.col("published_at")).alias("published_at"),
        F.col("text").alias("body"),
        F.col("tags"),
    )
    t = topic_of_article(spark, sf_dir).withColumnRenamed("article_id", "id")
    return rows.join(t, "id", "left").select(
        "id", "url", "content_hash", "title", "author", "published_at", "body",
        F.coalesce(F.col("topic_id"), F.lit(-1)).cast("int").alias("topic_id"),
        F.when(F.col("topic_id") == -1, F.lit(0.0)).otherwise(F.lit(1.0)).alias("topic_prob"), "tags")
