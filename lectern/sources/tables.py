"""Reading the corpus tables and the derived article contract.

``article_view`` turns the driver's ``documents`` table into the raw
article contract (article_id, url, title, author, published_at, text, tags)
that every pipeline stage reads. It is a pure projection, so Catalyst
prunes columns and pushes filters into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derived article contract (shared with the SQL oracles).
URL_PREFIX = "https://corpus.example/library/"
TITLE_SUFFIX = " | corpus"
EPOCH = "2020-01-01"
DATE_SPAN_DAYS = 1461

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def article_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles: one row per document, the reference's raw-shard schema."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("article_id"),
        F.concat(F.lit(URL_PREFIX), d.source, F.lit("-"), d.doc_id.cast("string")).alias("url"),
        F.concat(d.source, F.lit(" "), d.doc_id.cast("string"), F.lit(TITLE_SUFFIX)).alias("title"),
        d.source.alias("author"),
        F.date_add(F.lit(EPOCH).cast("date"), (d.doc_id % DATE_SPAN_DAYS).cast("int"))
        .cast("string").alias("published_at"),
        d.text.alias("text"),
        F.array(d.lang, d.source).alias("tags"),
    )


def topic_of_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(article_id, topic_id): label of the matching vector, else -1."""
    a = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"))
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("article_id"), "label")
    return a.join(e, "article_id", "left").select(
        "article_id", F.coalesce(F.col("label"), F.lit(-1)).cast("int").alias("topic_id"))


def queries_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as a query table (query_id, query)."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
