"""The serving star derived from the input tables, and the views over it
(A8-A12, A15, A16, J1, J2, J8-J10, J15, L1-L6, M14).

Star: articles (serving rows), tags (dense ids in name order), article_tags,
tone (lexical scorer), topic terms and labels (class-based TF-IDF with the
topic of each article), topic sizes. Views are plain joins and aggregates;
the dimension sides (tags, topics) are small by nature and AQE broadcasts
them from their runtime size.
"""

from __future__ import annotations



from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.config import (DEFAULT_ARTICLE_LIMIT, DEFAULT_TOPIC_LIMIT, MAX_ARTICLE_LIMIT, MAX_TOPIC_LIMIT,
                            OUTLIER_TOPIC_ID, TONE_LABELS, TOPIC_MIN_DF, TOPIC_TOP_TERMS)
from lectern.functions.ids import key_ids
from lectern.operators import topics as TP
from lectern.operators.tone import score_articles
from lectern.plans import corpus
from lectern.session import written
from lectern.sources.tables import table

# Parameters of the views as registered.
TERM_MIN_DF = TOPIC_MIN_DF
SAMPLES_PER_TOPIC = 5
LIST_TAG = "en"
PARENT_THRESHOLD = 0.1


def star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The star's tables without bodies, each written once: every view of a
    query reads them, and documents are scanned a single time."""
    arts = written(corpus.serving_articles(spark, sf).drop("body"), "star_articles")
    tags = written(key_ids(arts.select(F.explode("tags").alias("name")), "name").select("id", "name"), "star_tags")
    links = (arts.select(F.col("id").alias("article_id"), F.explode("tags").alias("name")).distinct()
             .join(tags.select(F.col("id").alias("tag_id"), "name"), "name").select("article_id", "tag_id"))
    return {"articles": arts.drop("tags"), "tags": tags, "article_tags": links}


def tone(spark: SparkSession, sf: str) -> DataFrame:
    t = score_articles(corpus.raw_articles(spark, sf), lexicon=corpus.TONE_WORDS)
    return t.select("article_id", *[F.round(lb, 6).alias(lb) for lb in TONE_LABELS])


def topic_docs(spark: SparkSession, sf: str) -> DataFrame:
    """(article_id, topic_id, text), written once: the terms are counted in two passes."""
    a = corpus.serving_articles(spark, sf)
    return written(a.select(F.col("id").alias("article_id"), "topic_id", F.col("body").alias("text")), "topic_docs")


def topic_terms(spark: SparkSession, sf: str, min_df: int = TERM_MIN_DF) -> DataFrame:
    return TP.class_term_weights(topic_docs(spark, sf), ["topic_id"], min_df=min_df)


def topic_sizes(spark: SparkSession, sf: str) -> DataFrame:
    a = corpus.serving_articles(spark, sf)
    return a.groupBy("topic_id").agg(F.count(F.lit(1)).alias("size"))


def topics_table(spark: SparkSession, sf: str, weights: DataFrame | None = None) -> DataFrame:
    """Topic rows as the listings read them: id, label, top_terms, size. Term
    weights that are known already need not be counted again."""
    sizes = topic_sizes(spark, sf)
    terms = topic_terms(spark, sf) if weights is None else weights.where(F.col("term_rank") <= TOPIC_TOP_TERMS)
    terms = written(terms, "topic_terms")        # a few rows a topic, read twice
    labels = TP.topic_labels(terms)
    tt = terms.groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("term_rank", "term"))).alias("_t"))
    tt = tt.select("topic_id", F.transform("_t", lambda s: s["term"]).alias("top_terms"))
    return (sizes.join(labels, "topic_id", "left").join(tt, "topic_id", "left")
            .select(F.col("topic_id").alias("id"), "label", "top_terms", "size"))


def full_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Topic rows with everything that the listings show: label, top terms,
    size, parent, the tone distribution and the dominant tone."""
    weights = written(TP.class_term_weights(topic_docs(spark, sf), ["topic_id"], min_df=TERM_MIN_DF, top_n=None),
                      "topic_weights")
    topics = written(topics_table(spark, sf, weights), "topics")
    parents = TP.topic_parents(weights, topics.select(F.col("id").alias("topic_id"), "size"), PARENT_THRESHOLD)
    summary = topic_summary(corpus.serving_articles(spark, sf), tone(spark, sf), topics)
    return (topics.join(parents.select(F.col("topic_id").alias("id"), "parent_topic_id"), "id", "left")
            .join(tone_distribution(summary).withColumnRenamed("topic_id", "id"), "id", "left"))


# ------------------------------------------------------------------ views


def tag_frequency(s: dict) -> DataFrame:
    """Articles per tag."""
    return (s["article_tags"].join(s["tags"].select(F.col("id").alias("tag_id"), "name"), "tag_id")
            .groupBy("name").agg(F.countDistinct("article_id").alias("n_articles")))


def topic_summary(articles: DataFrame, tone_df: DataFrame, topics: DataFrame) -> DataFrame:
    """A9 + J10: per topic, article count and mean of each tone (inner joins)."""
    j = articles.select(F.col("id").alias("article_id"), "topic_id").join(tone_df, "article_id") \
        .join(topics.select(F.col("id").alias("topic_id"), "label"), "topic_id")
    return j.groupBy("topic_id", "label").agg(
        F.count(F.lit(1)).alias("n_articles"),
        *[F.round(F.avg(lb), 6).alias(f"mean_{lb}") for lb in TONE_LABELS])


def topic_tone(summary: DataFrame) -> DataFrame:
    """A10 (flattened): per topic and tone, mean, share of the sum of means
    (null when all are 0) and whether it is the dominant tone (ties in label order)."""
    rows = summary.select("topic_id", F.posexplode(F.array(*[
        F.struct(F.lit(lb).alias("tone"), F.col(f"mean_{lb}").alias("mean")) for lb in TONE_LABELS]))
        .alias("tone_order", "t"))
    rows = rows.select("topic_id", "tone_order", "t.tone", "t.mean")
    w = Window.partitionBy("topic_id")
    tot = F.sum("mean").over(w)
    best = Window.partitionBy("topic_id").orderBy(F.desc("mean"), "tone_order")
    return rows.select(
        "topic_id", "tone", "mean",
        F.round(F.when(tot > 0, F.col("mean") / tot), 6).alias("share"),
        (F.row_number().over(best) == 1).alias("dominant"))


def tone_distribution(summary: DataFrame) -> DataFrame:
    """A10 as the topics table stores it: map tone -> share and dominant tone."""
    tt = topic_tone(summary)
    return tt.groupBy("topic_id").agg(
        F.map_from_entries(F.collect_list(F.struct("tone", "share"))).alias("tone_distribution"),
        F.max(F.when(F.col("dominant"), F.col("tone"))).alias("dominant_tone"))


def topics_over_time(docs_with_dates: DataFrame, min_df: int = TERM_MIN_DF, n_terms: int = 5) -> DataFrame:
    """Per (topic, month): articles and the top terms of that slice."""
    d = docs_with_dates.withColumn("period", F.trunc("published_at", "month"))
    freq = d.groupBy("topic_id", "period").agg(F.count(F.lit(1)).alias("frequency"))
    terms = TP.class_term_weights(d, ["topic_id", "period"], min_df=min_df, top_n=n_terms)
    words = terms.groupBy("topic_id", "period").agg(
        F.array_sort(F.collect_list(F.struct("term_rank", "term"))).alias("_t"))
    words = words.select("topic_id", "period", F.array_join(F.transform("_t", lambda s: s["term"]), ", ").alias("terms"))
    return freq.join(words, ["topic_id", "period"], "left")


def corpus_stats(tagfreq: DataFrame, sizes: DataFrame, tone_df: DataFrame) -> DataFrame:
    """One long table (stat, key, value)."""
    a = tagfreq.select(F.lit("tag_articles").alias("stat"), F.col("name").alias("key"),
                       F.col("n_articles").cast("double").alias("value"))
    b = sizes.select(F.lit("topic_size").alias("stat"), F.col("topic_id").cast("string").alias("key"),
                     F.col("size").cast("double").alias("value"))
    c = tone_df.select(F.explode(F.array(*[F.struct(F.lit(lb).alias("k"), F.col(lb).alias("v"))
                                           for lb in TONE_LABELS])).alias("x")) \
        .groupBy(F.col("x.k").alias("key")).agg(F.round(F.avg("x.v"), 6).alias("value")) \
        .select(F.lit("mean_tone").alias("stat"), "key", "value")
    return a.unionByName(b).unionByName(c)


def article_tag_names(s: dict) -> DataFrame:
    return (s["article_tags"].join(s["tags"].select(F.col("id").alias("tag_id"), "name"), "tag_id")
            .groupBy("article_id").agg(F.array_sort(F.collect_list("name")).alias("tags")))


def articles_flat(s: dict, topics: DataFrame, tone_df: DataFrame, labels: DataFrame) -> DataFrame:
    """Articles with topic label, tone, quality labels and tag list (four left joins)."""
    a = s["articles"].select("id", "title", "url", "author", "published_at", "topic_id")
    return (a.join(topics.select(F.col("id").alias("topic_id"), F.col("label").alias("topic_label")), "topic_id", "left")
            .join(tone_df.withColumnRenamed("article_id", "id"), "id", "left")
            .join(labels.select(F.col("doc_id").alias("id"), "quality", "toxic"), "id", "left")
            .join(article_tag_names(s).withColumnRenamed("article_id", "id"), "id", "left")
            .withColumn("tags", F.array_join(F.coalesce("tags", F.array().cast("array<string>")), "|")))


def article_detail(s: dict, topics: DataFrame, tone_df: DataFrame) -> DataFrame:
    """Every article with its tags, topic and tone, each optional."""
    a = s["articles"].select("id", "title", "url", "topic_id", "topic_prob")
    t = topics.select(F.col("id").alias("topic_id"), F.col("label").alias("topic_label"),
                      F.col("size").alias("topic_size"),
                      F.array_join(F.coalesce("top_terms", F.array().cast("array<string>")), ", ").alias("topic_terms"))
    return (a.join(t, "topic_id", "left")
            .join(tone_df.withColumnRenamed("article_id", "id"), "id", "left")
            .join(article_tag_names(s).withColumnRenamed("article_id", "id"), "id", "left")
            .withColumn("tags", F.array_join(F.coalesce("tags", F.array().cast("array<string>")), "|")))


def get_article(detail: DataFrame, article_id: int):
    """L3: one article or LookupError."""
    rows = detail.where(F.col("id") == article_id).take(1)
    if not rows:
        raise LookupError(f"article {article_id} is not in the store")
    return rows[0]


def get_topic(topics: DataFrame, topic_id: int):
    rows = topics.where(F.col("id") == topic_id).take(1)
    if not rows:
        raise LookupError(f"topic {topic_id} is not in the store")
    r = rows[0].asDict()
    r["top_terms"] = r.get("top_terms") or []
    return r


def check_page(limit: int, offset: int, max_limit: int) -> None:
    if limit <= 0:
        raise ValueError(f"a page of {limit} rows is empty")
    if limit > max_limit:
        raise ValueError(f"a page holds up to {max_limit} rows, {limit} were asked for")
    if offset < 0:
        raise ValueError(f"a page cannot begin at {offset}")


def articles_with_tag(s: dict, tag: str) -> DataFrame:
    """Articles having a tag (semi join, no row multiplication)."""
    ids = s["article_tags"].join(s["tags"].where(F.col("name") == tag).select(F.col("id").alias("tag_id")),
                                 "tag_id").select(F.col("article_id").alias("id"))
    return s["articles"].join(ids, "id", "left_semi")


def list_articles(s: dict, topic_id: int | None = None, tag: str | None = None,
                  limit: int = DEFAULT_ARTICLE_LIMIT, offset: int = 0) -> DataFrame:
    """L1: one page of articles by id, optional topic and tag filters, tags nested."""
    check_page(limit, offset, MAX_ARTICLE_LIMIT)
    a = s["articles"]
    if topic_id is not None:
        a = a.where(F.col("topic_id") == topic_id)
    if tag is not None:
        a = articles_with_tag({**s, "articles": a}, tag)
    page = a.select("id", "title", "url", "topic_id").orderBy("id").offset(offset).limit(limit)
    return page.join(article_tag_names(s).withColumnRenamed("article_id", "id"), "id", "left")


def list_topics(topics: DataFrame, limit: int = DEFAULT_TOPIC_LIMIT, offset: int = 0, include_outliers: bool = False) -> DataFrame:
    """L2: size desc (unsized last), then id; the outlier topic only on request."""
    check_page(limit, offset, MAX_TOPIC_LIMIT)
    t = topics if include_outliers else topics.where(F.col("id") > OUTLIER_TOPIC_ID)
    return t.orderBy(F.desc_nulls_last("size"), "id").offset(offset).limit(limit)


def topic_samples(articles: DataFrame, n: int = SAMPLES_PER_TOPIC) -> DataFrame:
    """The n articles of each topic with the highest topic_prob (ties by id)."""
    w = Window.partitionBy("topic_id").orderBy(F.desc("topic_prob"), "id")
    return (articles.select("topic_id", "id", "title", "topic_prob")
            .withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n))


def tag_topic_edges(s: dict) -> DataFrame:
    """Tag-topic co-occurrence weights."""
    return (s["article_tags"].join(s["tags"].select(F.col("id").alias("tag_id"), "name"), "tag_id")
            .join(s["articles"].select(F.col("id").alias("article_id"), "topic_id"), "article_id")
            .groupBy(F.col("name").alias("tag"), "topic_id").agg(F.count(F.lit(1)).alias("weight")))


def bridge_tags(edges: DataFrame) -> DataFrame:
    """Per tag, topics reached and the entropy of its edge weights."""
    w = Window.partitionBy("tag")
    p = F.col("weight") / F.sum("weight").over(w)
    e = edges.withColumn("_p", p)
    return e.groupBy("tag").agg(
        F.count(F.lit(1)).alias("n_topics"),
        F.sum("weight").alias("n_articles"),
        F.round(-F.sum(F.col("_p") * F.log("_p")), 6).alias("entropy"))


