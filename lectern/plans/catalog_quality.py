"""Registered data-quality queries (V1-V14) over tables with planted faults.

Every query takes a table, adds faulty copies of its own rows (null, blank,
duplicate, wrong length, not a number, out of range, orphan keys) by the same
expressions in Spark and in SQL, and restates every rule in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.config import TONE_LABELS
from lectern.operators import quality as Q
from lectern.plans import corpus
from lectern.plans import oracle_sql as O
from lectern.plans import star as ST
from lectern.plans.catalog import _TONE_SQL, _TW_SQL, register
from lectern.plans.catalog_store import PAGES_SQL, second_batch
from lectern.plans.catalog_views import _CENT, _assignments
from lectern.sources.tables import table

SHIFT = 1_000_000_000      # ids of faulty copies lie beyond those of the tables


def _rows_sql(source: str, key: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS rule, {key} AS key, CAST(NULL AS VARCHAR) AS detail FROM {source} "
                              f"WHERE {cond}" for name, cond in rules)


def _dupes_sql(source: str, cols: list[str], rule: str) -> str:
    key = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return (f" UNION ALL SELECT '{rule}', coalesce({key}, ''), 'count=' || CAST(count(*) AS VARCHAR) FROM {source} "
            f"GROUP BY {', '.join(cols)} HAVING count(*) > 1")


def _blank_sql(c: str) -> str:
    return f"{c} IS NOT NULL AND trim({c}, {O.WS}) = ''"


def _union(first, *more):
    for m in more:
        first = first.unionByName(m.select(*first.columns))
    return first


# ---------------------------------------------------------------- chunks


@register("dq_chunks", O.with_(O.ART, O.chunks_cte(), """
f AS (SELECT article_id, title, CAST(idx AS BIGINT) AS idx, chunk_text FROM chunks
      UNION ALL SELECT article_id, title, CAST(idx AS BIGINT), chunk_text FROM chunks WHERE idx = 0
      UNION ALL SELECT article_id, title, CAST(-1 AS BIGINT), ' ' || chr(10) || chr(9) FROM chunks WHERE idx = 0
      UNION ALL SELECT article_id, CAST(NULL AS VARCHAR), CAST(-2 AS BIGINT), chunk_text FROM chunks WHERE idx = 0)""")
    + _rows_sql("f", "CAST(article_id AS VARCHAR) || ',' || CAST(idx AS VARCHAR)", [
        ("chunk_null", "article_id IS NULL OR idx IS NULL OR chunk_text IS NULL OR title IS NULL"),
        ("chunk_blank", _blank_sql("chunk_text"))])
    + _dupes_sql("f", ["article_id", "idx"], "chunk_duplicate"))
def q_dq_chunks(spark, sf):
    c = corpus.chunks(spark, sf).select("article_id", "title", F.col("idx").cast("long").alias("idx"), "chunk_text")
    first = c.where("idx = 0")
    return Q.chunk_violations(_union(
        c, first, first.withColumn("idx", F.lit(-1).cast("long")).withColumn("chunk_text", F.lit(" \n\t")),
        first.withColumn("idx", F.lit(-2).cast("long")).withColumn("title", F.lit(None).cast("string"))))


@register("dq_titles", O.with_(O.ART, O.chunks_cte(), """
f AS (SELECT article_id, title FROM chunks UNION ALL SELECT article_id, title || ' (other)' FROM chunks WHERE idx = 1)""") + """
SELECT 'title_conflict' AS rule, CAST(article_id AS VARCHAR) AS key, 'titles=' || CAST(count(DISTINCT title) AS VARCHAR) AS detail
FROM f GROUP BY article_id HAVING count(DISTINCT title) > 1""")
def q_dq_titles(spark, sf):
    c = corpus.chunks(spark, sf).select("article_id", "title", "idx")
    return Q.title_violations(_union(c, c.where("idx = 1").withColumn("title", F.concat("title", F.lit(" (other)")))))


# ---------------------------------------------------------------- vectors


@register("dq_vectors", f"""
WITH f AS (SELECT vec_id, embedding FROM embeddings
  UNION ALL SELECT vec_id, embedding FROM embeddings WHERE label IS NULL
  UNION ALL SELECT vec_id + {SHIFT}, embedding[1:63] FROM embeddings
  UNION ALL SELECT vec_id + 2 * CAST({SHIFT} AS BIGINT), list_concat(['nan'::FLOAT], embedding[2:]) FROM embeddings
  UNION ALL SELECT vec_id + 3 * CAST({SHIFT} AS BIGINT), list_concat(embedding[1:63], ['-inf'::FLOAT]) FROM embeddings
  UNION ALL SELECT vec_id + 4 * CAST({SHIFT} AS BIGINT), NULL FROM embeddings
  UNION ALL SELECT NULL, embedding FROM embeddings)
""" + _rows_sql("f", "coalesce(CAST(vec_id AS VARCHAR), '')", [
    ("id_null", "vec_id IS NULL"), ("vector_null", "embedding IS NULL"), ("vector_length", "len(embedding) <> 64"),
    ("vector_non_finite", "len(list_filter(embedding, lambda x: isnan(x) OR isinf(x))) > 0")])
    + _dupes_sql("f", ["vec_id"], "id_duplicate"))
def q_dq_vectors(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").cast("long").alias("article_id"), "embedding", "label")

    def bad(step, vector):
        return e.withColumn("article_id", F.col("article_id") + step * SHIFT).withColumn("embedding", vector)
    return Q.vector_violations(_union(
        e, e.where("label is null"), bad(1, F.slice("embedding", 1, 63)),
        bad(2, F.concat(F.array(F.lit(float("nan")).cast("float")), F.expr("slice(embedding, 2, 63)"))),
        bad(3, F.concat(F.slice("embedding", 1, 63), F.array(F.lit(float("-inf")).cast("float")))),
        bad(4, F.lit(None).cast("array<float>")),
        e.withColumn("article_id", F.lit(None).cast("long"))), 64, check_title=False)


# ---------------------------------------------------------------- documents and raw articles


@register("dq_documents", f"""
WITH f AS (SELECT doc_id, text FROM documents
  UNION ALL SELECT doc_id, text FROM documents WHERE lang = 'es'
  UNION ALL SELECT doc_id + {SHIFT}, NULL FROM documents
  UNION ALL SELECT doc_id + 2 * CAST({SHIFT} AS BIGINT), ' ' || chr(9) FROM documents
  UNION ALL SELECT NULL, text FROM documents)
""" + _rows_sql("f", "CAST(doc_id AS VARCHAR)", [
    ("id_null", "doc_id IS NULL"), ("text_null", "text IS NULL"), ("text_blank", _blank_sql("text"))])
    + _dupes_sql("f", ["doc_id"], "id_duplicate"))
def q_dq_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return Q.document_violations(_union(
        d, d.where("lang = 'es'"),
        d.withColumn("doc_id", F.col("doc_id") + SHIFT).withColumn("text", F.lit(None).cast("string")),
        d.withColumn("doc_id", F.col("doc_id") + 2 * SHIFT).withColumn("text", F.lit(" \t")),
        d.withColumn("doc_id", F.lit(None).cast("long"))), key="doc_id")


_RAW_SQL = f"""
f AS (SELECT article_id, url, text FROM b2
  UNION ALL SELECT article_id, url || '#other', text FROM pga
  UNION ALL SELECT NULL, url, text FROM pga
  UNION ALL SELECT article_id - {SHIFT}, NULL, text FROM pga
  UNION ALL SELECT article_id - 2 * CAST({SHIFT} AS BIGINT), url, NULL FROM pga
  UNION ALL SELECT article_id - 3 * CAST({SHIFT} AS BIGINT), '  ', text FROM pga
  UNION ALL SELECT article_id - 4 * CAST({SHIFT} AS BIGINT), url, chr(10) FROM pga)"""


def _faulty_batch(spark, sf):
    b = second_batch(spark, sf)
    p = b.where("article_id < 0")
    null = F.lit(None).cast("string")

    def shifted(step, col, value):
        return p.withColumn("article_id", F.col("article_id") - step * SHIFT).withColumn(col, value)
    return _union(b, p.withColumn("url", F.concat("url", F.lit("#other"))),
                  p.withColumn("article_id", F.lit(None).cast("long")), shifted(1, "url", null),
                  shifted(2, "text", null), shifted(3, "url", F.lit("  ")), shifted(4, "text", F.lit("\n")))


@register("dq_articles", O.with_(O.ART, PAGES_SQL, _RAW_SQL) + _rows_sql("f", "CAST(article_id AS VARCHAR)", [
    ("id_null", "article_id IS NULL"), ("url_null", "url IS NULL"), ("text_null", "text IS NULL"),
    ("url_blank", _blank_sql("url")), ("text_blank", _blank_sql("text"))])
    + _dupes_sql("f", ["article_id"], "id_duplicate"))
def q_dq_articles(spark, sf):
    return Q.raw_article_violations(_faulty_batch(spark, sf))


@register("dq_source_urls", O.with_(O.ART, PAGES_SQL, _RAW_SQL) + """
SELECT 'url_conflict' AS rule, CAST(article_id AS VARCHAR) AS key, 'urls=' || CAST(count(DISTINCT trim(url)) AS VARCHAR) AS detail
FROM f GROUP BY article_id HAVING count(DISTINCT trim(url)) > 1""")
def q_dq_source_urls(spark, sf):
    return Q.source_url_violations(_faulty_batch(spark, sf))


@register("dq_cross_shard", """
SELECT 'id_in_many_shards' AS rule, CAST(article_id AS VARCHAR) AS key, 'shards=' || CAST(count(DISTINCT shard) AS VARCHAR) AS detail
FROM (SELECT doc_id AS article_id, 'documents' AS shard FROM documents
      UNION ALL SELECT doc_id, 'labels' FROM labels) GROUP BY article_id HAVING count(DISTINCT shard) > 1""")
def q_dq_cross_shard(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("article_id"), F.lit("documents").alias("shard"))
    lb = table(spark, sf, "labels").select(F.col("doc_id").alias("article_id"), F.lit("labels").alias("shard"))
    return Q.cross_shard_violations(d.unionByName(lb))


# ---------------------------------------------------------------- tone and topics


_TONE_FAULTS = (("academic", "-0.5"), ("militant", "1.5"), ("hopeful", "'nan'::DOUBLE"), ("critical", "NULL"))


@register("dq_tone", O.with_(O.ART, _TW_SQL, _TONE_SQL) + f""",
g AS (SELECT article_id, {', '.join(f'round({lb}, 6) AS {lb}' for lb in TONE_LABELS)} FROM tone),
f AS (SELECT * FROM g UNION ALL SELECT * FROM g WHERE militant > 0 """ + " ".join(
    f"UNION ALL SELECT article_id + {i} * CAST({SHIFT} AS BIGINT), "
    + ", ".join(value if lb == label else lb for lb in TONE_LABELS) + " FROM g"
    for i, (label, value) in enumerate(_TONE_FAULTS, 1)) + ") "
    + _rows_sql("f", "CAST(article_id AS VARCHAR)", [
        (f"{lb}_range", f"{lb} IS NULL OR isnan({lb}) OR {lb} < 0 OR {lb} > 1") for lb in TONE_LABELS])
    + _dupes_sql("f", ["article_id"], "id_duplicate"))
def q_dq_tone(spark, sf):
    g = ST.tone(spark, sf)
    values = {"academic": F.lit(-0.5), "militant": F.lit(1.5), "hopeful": F.lit(float("nan")),
              "critical": F.lit(None).cast("double")}
    return Q.tone_violations(_union(g, g.where("militant > 0"), *[
        g.withColumn("article_id", F.col("article_id") + i * SHIFT).withColumn(lb, values[lb])
        for i, (lb, _) in enumerate(_TONE_FAULTS, 1)]))


@register("dq_assignments", "WITH " + _CENT.strip() + f""",
sl AS (SELECT a.article_id, a.topic_id, a.topic_prob,
              (SELECT list(x.sec_prob) FROM sec x WHERE x.article_id = a.article_id) AS sp FROM asg a),
f AS (SELECT article_id, topic_prob, sp FROM sl
  UNION ALL SELECT article_id, topic_prob, sp FROM sl WHERE topic_id = -1
  UNION ALL SELECT NULL, topic_prob, sp FROM sl
  UNION ALL SELECT article_id + {SHIFT}, 1.25, sp FROM sl
  UNION ALL SELECT article_id + 2 * CAST({SHIFT} AS BIGINT), 'nan'::DOUBLE, sp FROM sl
  UNION ALL SELECT article_id + 3 * CAST({SHIFT} AS BIGINT), NULL, sp FROM sl
  UNION ALL SELECT article_id + 4 * CAST({SHIFT} AS BIGINT), topic_prob, [2.0] FROM sl)
""" + _rows_sql("f", "CAST(article_id AS VARCHAR)", [
    ("id_null", "article_id IS NULL"),
    ("prob_range", "topic_prob IS NULL OR isnan(topic_prob) OR topic_prob < 0 OR topic_prob > 1"),
    ("secondary_range", "len(list_filter(coalesce(sp, []), lambda p: p IS NULL OR isnan(p) OR p < 0 OR p > 1)) > 0")])
    + _dupes_sql("f", ["article_id"], "id_duplicate"))
def q_dq_assignments(spark, sf):
    a = _assignments(spark, sf)

    def bad(step, col, value):
        return a.withColumn("article_id", F.col("article_id") + step * SHIFT).withColumn(col, value)
    two = F.array(F.struct(F.lit(0).alias("topic_id"), F.lit(2.0).alias("probability")))
    return Q.assignment_violations(_union(
        a, a.where("topic_id = -1"), a.withColumn("article_id", F.lit(None).cast("long")),
        bad(1, "topic_prob", F.lit(1.25)), bad(2, "topic_prob", F.lit(float("nan"))),
        bad(3, "topic_prob", F.lit(None).cast("double")), bad(4, "secondary_topics", two)))


# ---------------------------------------------------------------- the star


_STAR_FAULTS = f"""
st_a AS (SELECT id, url, CAST(topic_id AS BIGINT) AS topic_id FROM sart
         UNION ALL SELECT id, url || '#', topic_id FROM sart WHERE topic_id = 0
         UNION ALL SELECT id + {SHIFT}, url, 999 FROM sart WHERE topic_id = 1),
st_t AS (SELECT DISTINCT unnest(tags) AS name FROM art UNION ALL SELECT 'en'),
st_at AS (SELECT a.article_id, n.name FROM art a, (SELECT unnest(['en', 'de', 'nowhere']) AS name) n
          WHERE list_contains(a.tags, n.name) OR (n.name = 'nowhere' AND list_contains(a.tags, 'es'))
          UNION ALL SELECT article_id, 'en' FROM art WHERE list_contains(tags, 'en')
          UNION ALL SELECT article_id + 5 * CAST({SHIFT} AS BIGINT), 'de' FROM art WHERE list_contains(tags, 'de')),
st_tp AS (SELECT DISTINCT CAST(topic_id AS BIGINT) AS id FROM sart),
st_c AS (SELECT article_id, CAST(idx AS BIGINT) AS position FROM chunks
         UNION ALL SELECT article_id, CAST(idx AS BIGINT) FROM chunks WHERE idx = 2
         UNION ALL SELECT article_id + 6 * CAST({SHIFT} AS BIGINT), CAST(idx AS BIGINT) FROM chunks WHERE idx = 0)"""


def _orphan_sql(source: str, col: str, ref: str, ref_col: str, rule: str) -> str:
    return (f" UNION ALL SELECT DISTINCT '{rule}', CAST({col} AS VARCHAR), CAST(NULL AS VARCHAR) FROM {source} "
            f"WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {ref_col} FROM {ref})")


@register("dq_star", O.with_(O.ART, O.TOPIC, O.SERVING, O.chunks_cte(), _STAR_FAULTS)
          + "SELECT NULL::VARCHAR AS rule, NULL::VARCHAR AS key, NULL::VARCHAR AS detail WHERE false"
          + _dupes_sql("st_a", ["id"], "article_id_duplicate") + _dupes_sql("st_a", ["url"], "article_url_duplicate")
          + _dupes_sql("st_t", ["name"], "tag_name_duplicate")
          + _dupes_sql("st_c", ["article_id", "position"], "chunk_duplicate")
          + _dupes_sql("st_at", ["article_id", "name"], "article_tag_duplicate").replace("CAST(name AS VARCHAR)", "name")
          + _orphan_sql("st_c", "article_id", "st_a", "id", "chunk_without_article")
          + _orphan_sql("st_at", "article_id", "st_a", "id", "link_without_article")
          + _orphan_sql("st_at", "name", "st_t", "name", "link_without_tag")
          + _orphan_sql("st_a", "topic_id", "st_tp", "id", "article_topic_missing"))
def q_dq_star(spark, sf):
    """A star whose tag ids are the names themselves, with every fault planted."""
    a = corpus.serving_articles(spark, sf)
    tags = a.select("id", "tags")
    topic = F.col("topic_id").cast("long").alias("topic_id")
    articles = a.select("id", "url", topic)

    def linked(name, key="id"):
        return tags.where(F.array_contains("tags", name)).select(F.col(key).alias("article_id"), F.lit(name).alias("tag_id"))
    c = corpus.chunks(spark, sf).select("article_id", F.col("idx").cast("long").alias("position"))
    star = {
        "articles": _union(
            articles, articles.where("topic_id = 0").withColumn("url", F.concat("url", F.lit("#"))),
            articles.where("topic_id = 1").withColumn("id", F.col("id") + SHIFT).withColumn("topic_id", F.lit(999).cast("long"))),
        "tags": _union(a.select(F.explode("tags").alias("name")).distinct(), spark.range(1).select(F.lit("en").alias("name")))
        .withColumn("id", F.col("name")),
        "article_tags": _union(
            linked("en"), linked("de"), linked("es").withColumn("tag_id", F.lit("nowhere")), linked("en"),
            linked("de").withColumn("article_id", F.col("article_id") + 5 * SHIFT)),
        "topics": articles.select(F.col("topic_id").alias("id")).distinct(),
        "chunks": _union(c, c.where("position = 2"),
                         c.where("position = 0").withColumn("article_id", F.col("article_id") + 6 * SHIFT)),
    }
    return Q.star_violations(star)
