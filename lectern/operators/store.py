"""Keyed upserts into the serving star (W6, W7, W10, J5-J7) and the load job.

A store is a dict of DataFrames: articles, tags, article_tags, topics,
chunks. Each upsert is one full outer (or anti) join on the key plus
``coalesce`` choices, with no per-row statements and no dependence on batch
order. New ids are assigned in key order after the current maximum without a
single-partition window (``dense_ids``). How a store lies on disk, and how a
load touches only some of it, is in ``buckets``.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.config import TONE_LABELS
from lectern.functions.ids import key_ids
from lectern.functions.text import content_hash, normalize_tags, parse_published_at
from lectern.session import written

SECONDARY_TYPE = "array<struct<topic_id:int,probability:double>>"

ARTICLE_COLUMNS = ("id", "url", "content_hash", "title", "author", "published_at", "body",
                   "topic_id", "topic_prob", "secondary_topics", "created_at")
RAW_COLUMNS = ("article_id", "url", "title", "author", "published_at", "text", "tags")


def empty_store(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "articles": spark.createDataFrame([], f"id long, url string, content_hash string, title string, "
                                              f"author string, published_at date, body string, topic_id int, "
                                              f"topic_prob double, secondary_topics {SECONDARY_TYPE}, "
                                              f"created_at timestamp"),
        "tags": spark.createDataFrame([], "id long, name string"),
        "article_tags": spark.createDataFrame([], "article_id long, tag_id long"),
        "topics": spark.createDataFrame([], "id int, label string"),
        "chunks": spark.createDataFrame([], "article_id long, position int, text string, "
                                            "embedding array<float>"),
        "tone": spark.createDataFrame([], "article_id long, " + ", ".join(f"{lb} double" for lb in TONE_LABELS)),
    }


def _max_id(df: DataFrame, col: str = "id") -> int:
    row = df.agg(F.max(col).alias("m")).first()
    return int(row.m) if row is not None and row.m is not None else 0


def latest_per_key(batch: DataFrame, key: list[str], order: str) -> DataFrame:
    """Within one batch the last row per key (by ``order``) wins."""
    w = Window.partitionBy(*key).orderBy(F.desc(order))
    return batch.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")


def latest_rows(batch: DataFrame, key: list[str], order: str) -> DataFrame:
    """``latest_per_key`` for wide rows: keys are counted alone, and only rows
    whose key repeats are shuffled and sorted."""
    names = [f"_k{i}" for i in range(len(key))]
    repeated = written(batch.groupBy(*[F.col(c).alias(n) for c, n in zip(key, names)]).count()
                       .where("count > 1").select(*names), "repeated_keys")
    if repeated.isEmpty():
        return batch
    same = functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(key, names)])
    return batch.join(repeated, same, "left_anti").unionByName(
        latest_per_key(batch.join(repeated, same, "left_semi"), key, order))


def repeated_urls(batch: DataFrame) -> DataFrame:
    """The report of urls that a batch holds more than once: (url, n_rows,
    kept_source_id). The row with the largest source id wins, as if the rows
    had been loaded one after the other."""
    return (batch.groupBy("url").agg(F.count(F.lit(1)).alias("n_rows"), F.max("source_id").alias("kept_source_id"))
            .where(F.col("n_rows") > 1))


def prepare_batch(raw: DataFrame) -> DataFrame:
    """Raw article rows -> the loader's row shape (P6, P7, P14), url stripped."""
    missing = set(RAW_COLUMNS) - set(raw.columns)
    if missing:
        raise ValueError(f"raw articles lack the columns {', '.join(sorted(missing))}")
    return raw.select(
        F.col("article_id").alias("source_id"),
        F.regexp_replace("url", r"^\s+|\s+\z", "").alias("url"),
        content_hash(F.col("text")).alias("content_hash"),
        F.col("title").cast("string").alias("title"),
        F.col("author").cast("string").alias("author"),
        parse_published_at(F.col("published_at")).alias("published_at"),
        F.col("text").cast("string").alias("body"),
        normalize_tags(F.col("tags")).alias("tags"),
    )


def upsert_articles(articles: DataFrame, batch: DataFrame, load_ts: dt.datetime | None = None,
                    next_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Key url. New urls get new ids; matched rows take the batch's hash,
    title, author, date and body and keep id, topic fields and created_at.

    batch is ``prepare_batch`` output; of rows with one url the largest
    source id wins (``repeated_urls`` reports them). Returns (articles,
    source_map) where source_map is (source_id, url, id) for every batch row.
    ``next_id`` is the first new id where ``articles`` does not hold the largest one.
    """
    ts = F.lit(load_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).cast("timestamp")
    b = latest_rows(batch, ["url"], "source_id")
    fields = ("content_hash", "title", "author", "published_at", "body")
    # ids are given on the urls alone; bodies are joined last, on the url again
    fresh = batch.select("url").join(articles.select("url"), "url", "left_anti")
    fresh = key_ids(fresh, "url", "id", start=next_id or _max_id(articles) + 1)
    t = articles.alias("t").join(b.alias("b"), "url", "left")

    def pick(c):
        return F.when(F.col("b.source_id").isNotNull(), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))

    kept = t.select(
        F.col("t.id").alias("id"), "url", *[pick(c).alias(c) for c in fields],
        F.col("t.topic_id").alias("topic_id"), F.col("t.topic_prob").alias("topic_prob"),
        F.col("t.secondary_topics").alias("secondary_topics"), F.col("t.created_at").alias("created_at"))
    new = b.join(fresh, "url").select(
        "id", "url", *fields, F.lit(None).cast("int").alias("topic_id"),
        F.lit(None).cast("double").alias("topic_prob"),
        F.lit(None).cast(SECONDARY_TYPE).alias("secondary_topics"), ts.alias("created_at"))
    ids = articles.select("url", "id").unionByName(fresh)
    source_map = batch.select("source_id", "url").join(ids, "url")
    return kept.unionByName(new), source_map


def upsert_tags(tags: DataFrame, names: DataFrame, next_id: int | None = None) -> DataFrame:
    """Insert-if-absent by name; new ids follow the current max in name order."""
    new = names.select("name").distinct().join(tags.select("name"), "name", "left_anti")
    return tags.unionByName(key_ids(new, "name", "id", start=next_id or _max_id(tags) + 1).select("id", "name"))


def upsert_article_tags(links: DataFrame, batch: DataFrame, source_map: DataFrame,
                        tags: DataFrame) -> DataFrame:
    """J6 + W10: (article db id, tag id) links of the batch, insert-if-absent."""
    pairs = (batch.select("source_id", F.explode("tags").alias("name"))
             .join(source_map.select("source_id", F.col("id").alias("article_id")), "source_id")
             .join(tags.select(F.col("id").alias("tag_id"), "name"), "name")
             .select("article_id", "tag_id").distinct())
    return links.unionByName(pairs.join(links, ["article_id", "tag_id"], "left_anti"))


def topic_ids(assignments: DataFrame) -> DataFrame:
    """U3 + G6: distinct primary and secondary topic ids."""
    prim = assignments.select(F.col("topic_id").cast("int").alias("id"))
    sec = assignments.select(F.explode_outer("secondary_topics").alias("s")).select(
        F.col("s.topic_id").cast("int").alias("id"))
    return prim.union(sec).where(F.col("id").isNotNull()).distinct()


def placeholder_topics(topics: DataFrame, assignments: DataFrame) -> DataFrame:
    """Topic rows for every id referenced; -1 is labelled 'outlier'."""
    new = topic_ids(assignments).join(topics.select("id"), "id", "left_anti")
    rows = new.select("id", F.when(F.col("id") == -1, F.lit("outlier")).alias("label"))
    for c in topics.columns:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(topics.schema[c].dataType))
    return topics.unionByName(rows.select(*topics.columns))


def apply_topics(articles: DataFrame, assignments: DataFrame, source_map: DataFrame
                 ) -> tuple[DataFrame, DataFrame]:
    """Assignments keyed by source id onto articles; unmatched are skipped.

    A matched row overwrites all three topic fields, nulls included; of
    several source ids of one article the largest wins.
    Returns (articles, matched ids)."""
    a = (assignments.join(source_map.select("source_id", "id"),
                          assignments["article_id"] == source_map["source_id"])
         .select("id", "source_id", F.col("topic_id").cast("int").alias("_tid"),
                 F.col("topic_prob").cast("double").alias("_tp"),
                 F.col("secondary_topics").cast(SECONDARY_TYPE).alias("_st")))
    a = latest_per_key(a, ["id"], "source_id").drop("source_id").withColumn("_m", F.lit(True))
    j = articles.join(a, "id", "left")
    m = F.col("_m").isNotNull()
    out = j.select(*[
        F.when(m, F.col("_tid")).otherwise(F.col("topic_id")).alias("topic_id") if c == "topic_id" else
        F.when(m, F.col("_tp")).otherwise(F.col("topic_prob")).alias("topic_prob") if c == "topic_prob" else
        F.when(m, F.col("_st")).otherwise(F.col("secondary_topics")).alias("secondary_topics")
        if c == "secondary_topics" else F.col(c) for c in articles.columns])
    return out, a.select("id")


def unknown_source_ids(chunks: DataFrame, source_map: DataFrame) -> DataFrame:
    """Chunk source ids with no article in the source map."""
    return (chunks.select(F.col("article_id").alias("source_id")).distinct()
            .join(source_map.select("source_id"), "source_id", "left_anti"))


def upsert_chunks(chunks: DataFrame, batch: DataFrame, source_map: DataFrame,
                  expected_dimension: int | None = None, delete_missing: bool = False) -> DataFrame:
    """Key (article db id, position); text and vector replaced.

    batch: (article_id = source id, position, text, embedding). Of several
    source ids of one article the largest wins, position by position.
    Positions that vanished are kept unless ``delete_missing`` (our extension)."""
    b = batch.join(source_map.select(F.col("source_id").alias("article_id"), F.col("id").alias("_db")),
                   "article_id").select(F.col("_db").alias("article_id"), F.col("article_id").alias("_source"),
                                        *[c for c in chunks.columns if c != "article_id"])
    b = latest_rows(b, ["article_id", "position"], "_source").drop("_source")
    if expected_dimension is not None and "embedding" in b.columns:
        bad = b.where(F.size("embedding") != expected_dimension).limit(1).count()
        if bad:
            raise ValueError(f"chunk vectors are not all {expected_dimension} long")
    keep = chunks
    if delete_missing:
        keep = keep.join(b.select("article_id").distinct(), "article_id", "left_anti")
    else:
        # only articles that had chunks replace any; their keys, written, are few in most loads
        replaced = written(b.select("article_id", "position").join(
            keep.select("article_id").distinct(), "article_id", "left_semi"), "replaced_chunks")
        keep = keep.join(replaced, ["article_id", "position"], "left_anti")
    return keep.unionByName(b.select(*chunks.columns))


def upsert_tone(tone: DataFrame, batch: DataFrame, source_map: DataFrame) -> DataFrame:
    """Tone rows by article db id; the batch (keyed by source id) replaces. A score
    outside [0, 1], or none, is an error."""
    outside = F.lit(False)
    for lb in TONE_LABELS:
        outside = outside | F.col(lb).isNull() | F.isnan(lb) | ~F.col(lb).between(0, 1)
    if batch.where(outside).limit(1).count():
        raise ValueError("a tone score is missing or outside [0, 1]")
    b = batch.join(source_map.select("source_id", "id"), batch["article_id"] == source_map["source_id"])
    b = latest_per_key(b.select(F.col("id").alias("article_id"), "source_id", *TONE_LABELS), ["article_id"], "source_id")
    return tone.join(b.select("article_id"), "article_id", "left_anti").unionByName(b.select(*tone.columns))


def load(store: dict[str, DataFrame], raw: DataFrame, chunk_vectors: DataFrame | None = None,
         assignments: DataFrame | None = None, load_ts: dt.datetime | None = None,
         expected_dimension: int | None = None, tone: DataFrame | None = None
         ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Raw articles, optional topic assignments, chunk vectors, tone -> new store + summary row.

    Idempotent: loading the same inputs twice gives the same store."""
    from lectern.operators.quality import require_raw_articles
    require_raw_articles(raw)
    batch = prepare_batch(raw)
    articles, smap = upsert_articles(store["articles"], batch, load_ts)
    tags = upsert_tags(store["tags"], batch.select(F.explode("tags").alias("name")))
    links = upsert_article_tags(store["article_tags"], batch, smap, tags)
    topics = store["topics"]
    matched = None
    if assignments is not None:
        topics = placeholder_topics(topics, assignments)
        articles, matched = apply_topics(articles, assignments, smap)
    chunks = store["chunks"]
    if chunk_vectors is not None:
        unknown = unknown_source_ids(chunk_vectors, smap).limit(1).collect()
        if unknown:
            raise ValueError(f"chunks of article {unknown[0].source_id!r}, which is not in the batch")
        chunks = upsert_chunks(chunks, chunk_vectors, smap, expected_dimension)
    summary = load_summary(batch, chunk_vectors, matched)
    tones = store["tone"] if tone is None else upsert_tone(store["tone"], tone, smap)
    new = {"articles": articles, "tags": tags, "article_tags": links, "topics": topics, "chunks": chunks,
           "tone": tones}
    return new, summary


def load_summary(batch: DataFrame, chunk_vectors: DataFrame | None, matched: DataFrame | None) -> DataFrame:
    """One row (articles, tags, chunks, topic_articles), computed lazily.

    The four counts are rows of one long table folded by a global pivot,
    so nothing runs until the summary is read."""
    spark = batch.sparkSession
    parts = [batch.select(F.lit("articles").alias("metric")),
             batch.select("source_id", F.explode("tags").alias("_t")).distinct()
             .select(F.lit("tags").alias("metric"))]
    if chunk_vectors is not None:
        parts.append(chunk_vectors.select(F.lit("chunks").alias("metric")))
    if matched is not None:
        parts.append(matched.select(F.lit("topic_articles").alias("metric")))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    names = ["articles", "tags", "chunks", "topic_articles"]
    wide = long.groupBy().pivot("metric", names).count()
    return wide.select(*[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names])


# ------------------------------------------------------------------ files


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a file in one step: write beside it, then rename over it."""
    fs, p = _fs(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    tmp = hadoop.Path(path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), options)


def get_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where there is no such folder."""
    fs, p = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
