"""Staged batch pipeline (E2, E4): chunk -> embed -> topic -> tone -> load.

Each stage reads the Parquet written by the stage before it and writes its
own, so a run can restart from any stage; an unknown stage is an error and
a failure names its stage. Every stage is one Spark job over all shards.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.config import EMBEDDING_DIMENSION
from lectern.operators import buckets as B
from lectern.operators import store as S
from lectern.operators import topics as TP
from lectern.operators.chunk import chunk_articles
from lectern.operators.encode import encode_chunks
from lectern.operators.tone import score_articles
from lectern.operators.vectors import mean_pool
from lectern.session import written
from lectern.sources import files as IO

STAGES = ("chunk", "embed", "topic", "tone", "load")


class StageError(RuntimeError):
    def __init__(self, stage: str, cause: Exception):
        super().__init__(f"stage '{stage}' failed: {cause}")
        self.stage = stage


def _p(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def run_chunk(spark, raw_dir, root, **_):
    arts = IO.read_articles(spark, raw_dir)
    shard = F.regexp_extract(F.col("filename"), r"([^/]+?)(\.pq|\.parquet)?$", 1)
    ch = written(chunk_articles(arts.select("article_id", "title", "text", shard.alias("shard")),
                                keep=("title", "shard")), "chunks")
    IO.write_chunks(ch, _p(root, "cleaned"))


def run_embed(spark, raw_dir, root, encoder_factory=None, dim: int = EMBEDDING_DIMENSION, **_):
    ch = spark.read.parquet(_p(root, "cleaned"))
    # validation reads the vectors several times: encode once
    vec = written(encode_chunks(ch, encoder_factory, dim), "vectors")
    IO.write_chunk_vectors(vec, _p(root, "embeddings/chunks"), dim)
    pooled = mean_pool(spark.read.parquet(_p(root, "embeddings/chunks")), carry=("title",), check=True)
    IO.write_article_vectors(written(pooled, "pooled"), _p(root, "embeddings/articles"), dim)


def run_topic(spark, raw_dir, root, n_topics: int = 10, min_cluster_size: int = 50, **_):
    vec = spark.read.parquet(_p(root, "embeddings/articles"))
    models, assignments, _ = TP.fit_topics(vec.select("article_id", "embedding"), n_topics=n_topics,
                                           min_cluster_size=min_cluster_size)
    IO.write_topic_assignments(assignments, _p(root, "topics/assignments"))
    TP.save_models(models, _p(root, "topics/model"))


def run_tone(spark, raw_dir, root, classifier_factory=None, **_):
    arts = IO.read_articles(spark, raw_dir)
    IO.write_tone_scores(score_articles(arts.select("article_id", "text"), classifier_factory=classifier_factory),
                         _p(root, "tone/scores"))


def run_load(spark, raw_dir, root, dim: int = EMBEDDING_DIMENSION, **_):
    raw = IO.read_articles(spark, raw_dir).drop("filename")
    vec = spark.read.parquet(_p(root, "embeddings/chunks"))
    vec = vec.select("article_id", F.col("idx").alias("position"), F.col("chunk_text").alias("text"), "embedding")
    asg = IO.read_topic_assignments(spark, _p(root, "topics/assignments"))
    scores = _p(root, "tone/scores")
    tone = spark.read.parquet(scores) if S.path_exists(spark, scores) else None
    return B.merge_load(spark, _p(root, "store"), raw, chunk_vectors=vec, assignments=asg, tone=tone, expected_dimension=dim)


RUNNERS = {"chunk": run_chunk, "embed": run_embed, "topic": run_topic, "tone": run_tone, "load": run_load}


def run_pipeline(spark: SparkSession, raw_dir: str, root: str, start: str = "chunk", **options):
    """Run the stages from ``start`` on."""
    if start not in STAGES:
        raise ValueError(f"unknown stage '{start}'; expected one of {', '.join(STAGES)}")
    result = None
    for stage in STAGES[STAGES.index(start):]:
        try:
            result = RUNNERS[stage](spark, raw_dir, root, **options)
        except Exception as e:  # noqa: BLE001
            raise StageError(stage, e) from e
    return result
