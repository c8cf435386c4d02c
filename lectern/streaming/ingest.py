"""Incremental ingest (E5) with Structured Streaming.

New raw shards landing in a folder are read by a file stream. Of each
micro-batch the new and changed articles (J14) are chunked and encoded once,
get topics from the saved centroids (M7) and a tone, and are merged into the
serving store: only the buckets that their keys fall into are read and written,
and the store's views follow by deltas. The stream keeps no state of its own:
rows are matched by key against the store, so a batch that is replayed after a
loss finds its rows unchanged and writes nothing. Progress lives in the
checkpoint folder on shared storage; ``availableNow`` processes what is there
and stops.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import buckets as B
from lectern.operators import store as S
from lectern.operators.chunk import chunk_articles
from lectern.operators.encode import encode_chunks
from lectern.operators.tone import score_articles
from lectern.operators.topics import assign_topics, centroid_probabilities, centroid_scores, secondary_topics
from lectern.operators.vectors import mean_pool
from lectern.plans.corpus import remap_chunks, scan_nonblank
from lectern.session import discard, written

RAW_SCHEMA = ("article_id long, url string, title string, author string, published_at string, "
              "text string, tags array<string>")


def new_or_changed(raw: DataFrame, store_articles: DataFrame) -> DataFrame:
    """Raw rows whose url is not in the store, or whose loaded fields
    differ from the stored ones."""
    fields = ("content_hash", "title", "author", "published_at")
    batch = S.prepare_batch(raw).select("source_id", "url", *fields)
    same = batch.join(store_articles.select("url", *[F.col(c).alias(f"_{c}") for c in fields]), "url")
    for c in fields:
        same = same.where(F.col(c).eqNullSafe(F.col(f"_{c}")))
    # the ids alone, written: where few rows are unchanged, no text is shuffled to find them
    same = written(same.select(F.col("source_id").alias("article_id")), "unchanged_articles")
    return raw.join(same, "article_id", "left_anti")


def process_batch(spark: SparkSession, batch: DataFrame, store_root: str, centroids: DataFrame | None = None,
                  encoder_factory=None, load_ts: dt.datetime | None = None, lexicon: dict | None = None) -> DataFrame | None:
    """One micro-batch into the store; the load's summary row, or None where
    nothing was new."""
    scratch: list[str] = []
    state = B.read_state(spark, store_root)
    landed = written(scan_nonblank(batch), "ingest_landed", scratch)
    near = B.read_table(spark, store_root, state, "articles",
                        B.touched_buckets(S.prepare_batch(landed).select("url"), "url", state["buckets"]))
    raw = written(new_or_changed(landed, near), "ingest_raw", scratch)
    summary = None
    if not raw.isEmpty():
        # chunks, pooled vectors and the load read the encoded chunks; encode them once
        vec = written(remap_chunks(encode_chunks(chunk_articles(raw.select("article_id", "title", "text")),
                                                 encoder_factory)), "ingest_vectors", scratch)
        assignments = None
        if centroids is not None:
            pooled = written(mean_pool(vec), "ingest_pooled", scratch)       # two readers
            primary = assign_topics(pooled, centroids).select("article_id", "topic_id")
            assignments = written(secondary_topics(primary, centroid_probabilities(centroid_scores(pooled, centroids))),
                                  "ingest_topics", scratch)
        # checked and merged by several jobs; score the texts once
        tone = written(score_articles(raw.select("article_id", "text"), lexicon=lexicon), "ingest_tone", scratch)
        summary = B.merge_load(spark, store_root, raw, chunk_vectors=vec, assignments=assignments, load_ts=load_ts, tone=tone)
    discard(spark, scratch)
    return summary


def start_ingest(spark: SparkSession, landing: str, store_root: str, checkpoint: str,
                 centroids: DataFrame | None = None, encoder_factory=None, available_now: bool = True,
                 load_ts: dt.datetime | None = None, lexicon: dict | None = None, max_files: int = 16):
    """Start the stream; returns the StreamingQuery. New rows get ``load_ts``,
    by default the time of their batch, as created_at. A micro-batch takes at
    most ``max_files`` files."""
    stream = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(landing)

    def each(batch_df: DataFrame, epoch_id: int) -> None:
        process_batch(batch_df.sparkSession, batch_df, store_root, centroids, encoder_factory, load_ts, lexicon)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
