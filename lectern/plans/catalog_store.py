"""Registered queries for loading (upserts, E3) and data-quality rules.

Scenario, all derived from the input tables: the first load is the article
view of ``documents``; the second batch re-crawls the same urls with cleaned
text (P3) and adds the articles extracted from ``pages`` (P2), whose tags
are the page language and host. Loading it updates changed bodies, keeps
ids, topics and created_at, and appends the new urls with new ids.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lectern.functions.text import normalize_text
from lectern.operators import store as S
from lectern.plans import corpus
from lectern.plans import oracle_sql as O
from lectern.plans.catalog import _BODY_SQL, _PARSED_TITLE_SQL, normalize, register
from lectern.sources import pages as PG
from lectern.sources.tables import table

LOAD1_TS = dt.datetime(2024, 1, 1)
LOAD2_TS = dt.datetime(2024, 2, 1)
HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)"


def page_articles(spark, sf):
    """Raw article rows from stored pages: parse, clean, source id -(page_id + 1)."""
    a = PG.clean_articles(PG.extract_articles(table(spark, sf, "pages")))
    a = a.select((-(F.col("page_id") + 1)).alias("article_id"), "url", "title", "author", "published_at", "text",
                 F.array(F.col("lang"), F.regexp_extract("url", HOST_PATTERN, 1)).alias("tags"))
    return corpus.scan_nonblank(a)


def second_batch(spark, sf):
    docs = corpus.raw_articles(spark, sf).withColumn("text", normalize_text(F.col("text")))
    return docs.unionByName(page_articles(spark, sf))


def first_store(spark, sf):
    """The store after the first load, written once (checkpoint) as a real
    store table would be, so the second load reads it instead of redoing it."""
    store, _ = S.load(S.empty_store(spark), corpus.raw_articles(spark, sf), load_ts=LOAD1_TS)
    return {k: (v.checkpoint(eager=True) if k in ("articles", "tags", "article_tags") else v)
            for k, v in store.items()}


def _norm_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE trim(regexp_replace(replace(regexp_replace({x}, "
            f"'^---\\s*\\n(?s:.*?)\\n---\\s*\\n', ''), chr(10), ' '), '[ \\t]+', ' ', 'g'), {O.WS}) END")


PAGES_SQL = f"""
pg AS (SELECT -(page_id + 1) AS article_id, url,
              CASE WHEN t IS NULL OR t = '' THEN '' ELSE trim(split_part(t, '|', 1), {O.WS}) END AS title,
              '' AS author, '' AS published_at, {_norm_sql('body')} AS text,
              [nullif(regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1), ''),
               regexp_extract(url, '{HOST_PATTERN}', 1)] AS tags
       FROM (SELECT *, {_PARSED_TITLE_SQL} AS t, {_BODY_SQL} AS body FROM pages)),
pga AS (SELECT * FROM pg WHERE text IS NOT NULL AND trim(text) <> ''),
b2 AS (SELECT article_id, url, title, author, published_at, {_norm_sql('text')} AS text, tags FROM art
       UNION ALL SELECT * FROM pga),
b2p AS (SELECT * FROM (SELECT article_id AS source_id, trim(url, {O.WS}) AS url, sha256(text) AS content_hash, title,
                              author, CAST(try_strptime(substr(trim(published_at, {O.WS}), 1, 10), '%Y-%m-%d') AS DATE) AS published_at,
                              text AS body, row_number() OVER (PARTITION BY trim(url, {O.WS}) ORDER BY article_id DESC) AS r
                       FROM b2) WHERE r = 1),
s1 AS (SELECT row_number() OVER (ORDER BY trim(url, {O.WS})) AS id, trim(url, {O.WS}) AS url, sha256(text) AS content_hash, title, author,
              CAST(published_at AS DATE) AS published_at, text AS body, TIMESTAMP '2024-01-01 00:00:00' AS created_at
       FROM art),
up AS (SELECT s1.id, s1.url, b.content_hash, b.title, b.author, b.published_at, s1.created_at
       FROM s1 JOIN b2p b USING (url)
       UNION ALL SELECT id, url, content_hash, title, author, published_at, created_at FROM s1
       WHERE url NOT IN (SELECT url FROM b2p)
       UNION ALL SELECT (SELECT max(id) FROM s1) + row_number() OVER (ORDER BY url), url, content_hash, title, author,
                        published_at, TIMESTAMP '2024-02-01 00:00:00' FROM b2p WHERE url NOT IN (SELECT url FROM s1))"""


@register("upsert_articles", O.with_(O.ART, PAGES_SQL) + """
SELECT id, url, content_hash, title, author, published_at, created_at FROM up""")
def q_upsert_articles(spark, sf):
    store = first_store(spark, sf)
    out, _ = S.upsert_articles(store["articles"], S.prepare_batch(second_batch(spark, sf)), LOAD2_TS)
    return out.select("id", "url", "content_hash", "title", "author", "published_at", "created_at")


@register("new_articles", O.with_(O.ART, PAGES_SQL) + """
SELECT url FROM b2p WHERE url NOT IN (SELECT url FROM s1)""")
def q_new_articles(spark, sf):
    store = first_store(spark, sf)
    b = S.prepare_batch(second_batch(spark, sf)).select("url").distinct()
    return b.join(store["articles"].select("url"), "url", "left_anti")


TAGS_SQL = f"""
n1 AS (SELECT DISTINCT unnest(list_filter(list_transform(tags, lambda t: trim(t, {O.WS})),
                                           lambda t: t IS NOT NULL AND t <> '')) AS name FROM art),
t1 AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM n1),
n2 AS (SELECT DISTINCT unnest(list_filter(list_transform(tags, lambda t: trim(t, {O.WS})),
                                           lambda t: t IS NOT NULL AND t <> '')) AS name FROM b2),
t2 AS (SELECT * FROM t1 UNION ALL
       SELECT (SELECT max(id) FROM t1) + row_number() OVER (ORDER BY name), name FROM n2 WHERE name NOT IN (SELECT name FROM t1))"""


@register("upsert_tags", O.with_(O.ART, PAGES_SQL, TAGS_SQL) + "SELECT id, name FROM t2")
def q_upsert_tags(spark, sf):
    store = first_store(spark, sf)
    b = S.prepare_batch(second_batch(spark, sf))
    return S.upsert_tags(store["tags"], b.select(F.explode("tags").alias("name")))


@register("article_tags", O.with_(O.ART, PAGES_SQL, TAGS_SQL) + f""",
smap AS (SELECT b.source_id, u.id FROM (SELECT article_id AS source_id, trim(url, {O.WS}) AS url FROM b2) b
         JOIN up u USING (url)),
l1 AS (SELECT DISTINCT s1.id AS article_id, t.id AS tag_id FROM (SELECT trim(url, {O.WS}) AS url, unnest(tags) AS name FROM art) a
       JOIN s1 USING (url) JOIN t2 t USING (name)),
l2 AS (SELECT DISTINCT m.id AS article_id, t.id AS tag_id
       FROM (SELECT article_id AS source_id, unnest(list_filter(list_transform(tags, lambda t: trim(t, {O.WS})),
                                                   lambda t: t IS NOT NULL AND t <> '')) AS name FROM b2) x
       JOIN smap m USING (source_id) JOIN t2 t USING (name))
SELECT article_id, tag_id FROM l1 UNION SELECT article_id, tag_id FROM l2""")
def q_article_tags(spark, sf):
    store = first_store(spark, sf)
    store2, _ = S.load(store, second_batch(spark, sf), load_ts=LOAD2_TS)
    return store2["article_tags"]


@register("upsert_chunks", O.with_(O.ART, O.chunks_cte(),
                                   f"nart AS (SELECT article_id, title, {_norm_sql('text')} AS text FROM art)",
                                   O.chunks_cte("nart", p="n")) + """
SELECT article_id, idx AS position, chunk_text AS text FROM nchunks
UNION ALL SELECT article_id, idx, chunk_text FROM chunks c
WHERE NOT EXISTS (SELECT 1 FROM nchunks n WHERE n.article_id = c.article_id AND n.idx = c.idx)""")
def q_upsert_chunks(spark, sf):
    from lectern.operators.chunk import chunk_articles
    old = corpus.remap_chunks(corpus.chunks(spark, sf))
    arts = corpus.raw_articles(spark, sf)
    new = corpus.remap_chunks(chunk_articles(arts.withColumn("text", normalize_text(F.col("text")))
                                             .select("article_id", "title", "text")))
    smap = arts.select(F.col("article_id").alias("source_id"), F.col("article_id").alias("id"))
    return normalize(S.upsert_chunks(old, new, smap))


_ASG = "asg0 AS (SELECT vec_id AS article_id FROM embeddings)"


@register("load_summary", O.with_(O.ART, O.chunks_cte(), _ASG) + """
SELECT (SELECT count(*) FROM art) AS articles,
       (SELECT count(*) FROM (SELECT DISTINCT article_id, unnest(tags) FROM art)) AS tags,
       (SELECT count(*) FROM chunks) AS chunks,
       (SELECT count(*) FROM asg0 WHERE article_id IN (SELECT article_id FROM art)) AS topic_articles""")
def q_load_summary(spark, sf):
    from lectern.plans.catalog_views import _assignments
    raw = corpus.raw_articles(spark, sf)
    cv = corpus.chunk_vectors(spark, sf)
    _, summary = S.load(S.empty_store(spark), raw, chunk_vectors=cv, assignments=_assignments(spark, sf),
                        load_ts=LOAD1_TS)
    return summary


PLANTED = 1_000_000_000      # added to some ids, which no article then has


@register("unknown_source_ids", O.with_(O.ART) + f"""
SELECT DISTINCT source_id FROM (SELECT conv_id AS source_id FROM conversations
                                UNION ALL SELECT conv_id + {PLANTED} FROM conversations WHERE conv_id % 7 = 0)
WHERE source_id NOT IN (SELECT article_id FROM art)""")
def q_unknown_source_ids(spark, sf):
    """Chunk ids without an article; some are planted."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("article_id"))
    planted = c.where(F.col("article_id") % 7 == 0).select((F.col("article_id") + PLANTED).alias("article_id"))
    smap = corpus.raw_articles(spark, sf).select(F.col("article_id").alias("source_id"))
    return S.unknown_source_ids(c.unionByName(planted), smap)


@register("upsert_repeated_urls", O.with_(O.ART) + f""",
twice AS (SELECT article_id AS source_id, trim(url, {O.WS}) AS url, text FROM art
          UNION ALL SELECT article_id + 1000000000, trim(url, {O.WS}), text || ' again' FROM art),
win AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY source_id DESC) AS r FROM twice)
SELECT row_number() OVER (ORDER BY url) AS id, url, sha256(text) AS content_hash, source_id AS kept_source_id,
       CAST(2 AS BIGINT) AS n_rows
FROM win WHERE r = 1""")
def q_upsert_repeated_urls(spark, sf):
    """A batch that holds every url twice: the larger source id wins, the star
    keeps its keys, and the report names each url."""
    art = corpus.raw_articles(spark, sf)
    again = art.withColumn("article_id", F.col("article_id") + 1_000_000_000) \
        .withColumn("text", F.concat("text", F.lit(" again")))
    batch = S.prepare_batch(art.unionByName(again))
    out, _ = S.upsert_articles(S.empty_store(spark)["articles"], batch, LOAD1_TS)
    return out.join(S.repeated_urls(batch), "url").select("id", "url", "content_hash", "kept_source_id", "n_rows")
