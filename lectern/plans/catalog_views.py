"""Registered queries for the serving star, topic operators and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.config import TONE_LABELS, TOPIC_MIN_CLUSTER_SIZE
from lectern.operators import topics as TP
from lectern.operators import vectors as V
from lectern.plans import corpus, star as ST
from lectern.plans import oracle_sql as O
from lectern.plans.catalog import _TONE_SQL, _TW_SQL, normalize, register
from lectern.session import written
from lectern.sources.tables import table

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in TP.STOP_WORDS) + "]"


def cterms_sql(p: str, source: str, cls: str, min_df: int, top_n: int) -> str:
    """A13 in SQL: class-based term weights over ``source`` (article_id, <cls>, text)."""
    return f"""
{p}tok AS (SELECT article_id, {cls}, list_filter(regexp_extract_all(lower(text), '{O.TOK}'),
                 lambda x: length(x) >= 2 AND NOT list_contains({STOP_SQL}, x)) AS t FROM {source}),
{p}gr AS (SELECT article_id, {cls}, flatten([t,
             list_transform(range(0, len(t) - 1), lambda i: array_to_string(t[i + 1:i + 2], ' ')),
             list_transform(range(0, len(t) - 2), lambda i: array_to_string(t[i + 1:i + 3], ' '))]) AS g
          FROM {p}tok),
{p}tf AS (SELECT {cls}, term, count(*) AS cnt FROM (SELECT {cls}, unnest(g) AS term FROM {p}gr) GROUP BY ALL),
{p}dfq AS (SELECT term, count(*) AS dfc FROM (SELECT DISTINCT article_id, unnest(g) AS term FROM {p}gr) GROUP BY term),
{p}tfv AS (SELECT * FROM {p}tf WHERE term IN (SELECT term FROM {p}dfq WHERE dfc >= {min_df})),
{p}ncl AS (SELECT count(*) AS n FROM (SELECT DISTINCT {cls} FROM {source})),
{p}avgw AS (SELECT CAST(floor(CAST(sum(cnt) AS DOUBLE) / (SELECT n FROM {p}ncl)) AS BIGINT) AS a FROM {p}tfv),
{p}ct AS (SELECT {cls}, sum(cnt) AS c FROM {p}tfv GROUP BY ALL),
{p}ft AS (SELECT term, sum(cnt) AS f FROM {p}tfv GROUP BY term),
{p}wt AS (SELECT v.{cls.replace(', ', ', v.')}, v.term,
                 round(CAST(v.cnt AS DOUBLE) / CAST(c.c AS DOUBLE)
                       * ln(1 + CAST((SELECT a FROM {p}avgw) AS DOUBLE) / CAST(f.f AS DOUBLE)), 6) AS weight
          FROM {p}tfv v JOIN {p}ct c USING ({cls}) JOIN {p}ft f USING (term)),
{p}terms AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {cls} ORDER BY weight DESC, term) AS term_rank
                            FROM {p}wt) WHERE term_rank <= {top_n})"""


TDOC = "tdoc AS (SELECT a.article_id, t.topic_id, a.text FROM art a JOIN atopic t USING (article_id))"
TERMS = cterms_sql("k", "tdoc", "topic_id", ST.TERM_MIN_DF, 10)
LABELS = """tlabel AS (SELECT topic_id, CASE WHEN topic_id = -1 THEN 'outlier'
                  ELSE CAST(topic_id AS VARCHAR) || '_' || string_agg(term, '_' ORDER BY term_rank) END AS label
                  FROM kterms WHERE term_rank <= 4 GROUP BY topic_id)"""
SIZES = "tsize AS (SELECT topic_id, count(*) AS size FROM atopic GROUP BY topic_id)"
TOPICS = """ttab AS (SELECT s.topic_id AS id, l.label, s.size,
                    (SELECT string_agg(term, ', ' ORDER BY term_rank) FROM kterms k WHERE k.topic_id = s.topic_id) AS top_terms
             FROM tsize s LEFT JOIN tlabel l USING (topic_id))"""
STAR = """tagn AS (SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT unnest(tags) AS name FROM art)),
atag AS (SELECT DISTINCT a.article_id, t.id AS tag_id FROM (SELECT article_id, unnest(tags) AS name FROM art) a
         JOIN tagn t USING (name)),
atagn AS (SELECT article_id, string_agg(name, '|' ORDER BY name) AS tags FROM atag JOIN tagn ON tagn.id = atag.tag_id
          GROUP BY article_id)"""
TONER = ("toner AS (SELECT article_id, " + ", ".join(f"round({lb}, 6) AS {lb}" for lb in TONE_LABELS)
         + " FROM tone)")
BASE = (O.ART, O.TOPIC, O.SERVING)


def _s(spark, sf):
    return ST.star(spark, sf)


# ------------------------------------------------------------------ topic terms and labels


@register("topic_terms", O.with_(*BASE, TDOC, TERMS) + """
SELECT CAST(topic_id AS BIGINT) AS topic_id, term_rank, term, weight FROM kterms""")
def q_topic_terms(spark, sf):
    return normalize(ST.topic_terms(spark, sf))


@register("topic_labels", O.with_(*BASE, TDOC, TERMS, LABELS) + """
SELECT CAST(topic_id AS BIGINT) AS topic_id, label FROM tlabel""")
def q_topic_labels(spark, sf):
    return normalize(TP.topic_labels(ST.topic_terms(spark, sf)))


@register("topic_sizes", O.with_(*BASE, SIZES) + """
SELECT CAST(topic_id AS BIGINT) AS topic_id, size FROM tsize""")
def q_topic_sizes(spark, sf):
    return normalize(ST.topic_sizes(spark, sf))


_OVER_TIME = """
tdd AS (SELECT a.article_id, t.topic_id, date_trunc('month', CAST(a.published_at AS DATE)) AS period, a.text
        FROM art a JOIN atopic t USING (article_id)),""" + cterms_sql("o", "tdd", "topic_id, period", ST.TERM_MIN_DF, 5)


@register("topics_over_time", O.with_(*BASE) + "," + _OVER_TIME + """
SELECT CAST(f.topic_id AS BIGINT) AS topic_id, CAST(f.period AS DATE) AS period, f.frequency, w.terms
FROM (SELECT topic_id, period, count(*) AS frequency FROM tdd GROUP BY ALL) f
LEFT JOIN (SELECT topic_id, period, string_agg(term, ', ' ORDER BY term_rank) AS terms FROM oterms GROUP BY ALL) w
USING (topic_id, period)""")
def q_topics_over_time(spark, sf):
    d = corpus.serving_articles(spark, sf).select(
        F.col("id").alias("article_id"), "topic_id", "published_at", F.col("body").alias("text"))
    return normalize(ST.topics_over_time(written(d, "dated_docs")))


# ------------------------------------------------------------------ star views


@register("tags", O.with_(*BASE, STAR) + "SELECT id, name FROM tagn")
def q_tags(spark, sf):
    return _s(spark, sf)["tags"]


@register("tag_frequency", O.with_(*BASE, STAR) + """
SELECT t.name, count(DISTINCT a.article_id) AS n_articles FROM atag a JOIN tagn t ON t.id = a.tag_id GROUP BY t.name""")
def q_tag_frequency(spark, sf):
    return ST.tag_frequency(_s(spark, sf))


_TONE_BASE = (*BASE, _TW_SQL, _TONE_SQL, TONER)


@register("topic_summary", O.with_(*_TONE_BASE, TDOC, TERMS, LABELS, SIZES, TOPICS) + """
SELECT CAST(s.topic_id AS BIGINT) AS topic_id, t.label, count(*) AS n_articles, """ +
          ", ".join(f"round(avg(r.{lb}), 6) AS mean_{lb}" for lb in TONE_LABELS) + """
FROM sart s JOIN toner r ON r.article_id = s.id JOIN ttab t ON t.id = s.topic_id
GROUP BY s.topic_id, t.label""")
def q_topic_summary(spark, sf):
    s = _s(spark, sf)
    return normalize(ST.topic_summary(s["articles"], ST.tone(spark, sf), ST.topics_table(spark, sf)))


_SUMMARY = """summ AS (SELECT s.topic_id, """ + ", ".join(f"round(avg(r.{lb}), 6) AS mean_{lb}" for lb in TONE_LABELS) + """
FROM sart s JOIN toner r ON r.article_id = s.id GROUP BY s.topic_id),
tt1 AS (SELECT topic_id, tone_order, tone, mean FROM summ,
        LATERAL (SELECT unnest(range(0, 4)) AS tone_order, unnest(['academic', 'militant', 'hopeful', 'critical']) AS tone,
                        unnest([mean_academic, mean_militant, mean_hopeful, mean_critical]) AS mean))"""


@register("topic_tone", O.with_(*_TONE_BASE, _SUMMARY) + """
SELECT CAST(topic_id AS BIGINT) AS topic_id, tone, mean,
       round(CASE WHEN sum(mean) OVER (PARTITION BY topic_id) > 0 THEN mean / sum(mean) OVER (PARTITION BY topic_id) END, 6) AS share,
       row_number() OVER (PARTITION BY topic_id ORDER BY mean DESC, tone_order) = 1 AS dominant
FROM tt1""")
def q_topic_tone(spark, sf):
    s = _s(spark, sf)
    a = s["articles"]
    topics = a.select(F.col("topic_id").alias("id")).distinct().withColumn("label", F.lit(None).cast("string"))
    return normalize(ST.topic_tone(ST.topic_summary(a, ST.tone(spark, sf), topics)))


@register("corpus_stats", O.with_(*_TONE_BASE, STAR, SIZES) + """
SELECT 'tag_articles' AS stat, t.name AS key, CAST(count(DISTINCT a.article_id) AS DOUBLE) AS value
FROM atag a JOIN tagn t ON t.id = a.tag_id GROUP BY t.name
UNION ALL SELECT 'topic_size', CAST(topic_id AS VARCHAR), CAST(size AS DOUBLE) FROM tsize
UNION ALL SELECT 'mean_tone', k, round(avg(v), 6) FROM (SELECT unnest(['academic', 'militant', 'hopeful', 'critical']) AS k,
       unnest([academic, militant, hopeful, critical]) AS v FROM toner) GROUP BY k""")
def q_corpus_stats(spark, sf):
    s = _s(spark, sf)
    return ST.corpus_stats(ST.tag_frequency(s), ST.topic_sizes(spark, sf), ST.tone(spark, sf))


@register("articles_flat", O.with_(*_TONE_BASE, STAR, TDOC, TERMS, LABELS) + """
SELECT s.id, s.title, s.url, s.author, s.published_at, CAST(s.topic_id AS BIGINT) AS topic_id, l.label AS topic_label,
       """ + ", ".join(f"r.{lb}" for lb in TONE_LABELS) + """, CAST(lb.quality AS BIGINT) AS quality,
       CAST(lb.toxic AS BIGINT) AS toxic, coalesce(g.tags, '') AS tags
FROM sart s LEFT JOIN tlabel l ON l.topic_id = s.topic_id LEFT JOIN toner r ON r.article_id = s.id
LEFT JOIN labels lb ON lb.doc_id = s.id LEFT JOIN atagn g ON g.article_id = s.id""")
def q_articles_flat(spark, sf):
    s = _s(spark, sf)
    return normalize(ST.articles_flat(s, ST.topics_table(spark, sf), ST.tone(spark, sf), table(spark, sf, "labels")))


@register("article_detail", O.with_(*_TONE_BASE, STAR, TDOC, TERMS, LABELS, SIZES, TOPICS) + """
SELECT s.id, s.title, s.url, CAST(s.topic_id AS BIGINT) AS topic_id, s.topic_prob, t.label AS topic_label,
       t.size AS topic_size, coalesce(t.top_terms, '') AS topic_terms, """ + ", ".join(f"r.{lb}" for lb in TONE_LABELS) + """,
       coalesce(g.tags, '') AS tags
FROM sart s LEFT JOIN ttab t ON t.id = s.topic_id LEFT JOIN toner r ON r.article_id = s.id
LEFT JOIN atagn g ON g.article_id = s.id""")
def q_article_detail(spark, sf):
    s = _s(spark, sf)
    return normalize(ST.article_detail(s, ST.topics_table(spark, sf), ST.tone(spark, sf)))


@register("list_articles", O.with_(*BASE, STAR) + f"""
SELECT s.id, s.title, s.url, CAST(s.topic_id AS BIGINT) AS topic_id, g.tags FROM (
  SELECT * FROM sart WHERE id IN (SELECT article_id FROM atag JOIN tagn ON tagn.id = atag.tag_id
                                  WHERE name = '{ST.LIST_TAG}')
  ORDER BY id LIMIT 50 OFFSET 50) s LEFT JOIN atagn g ON g.article_id = s.id""")
def q_list_articles(spark, sf):
    page = ST.list_articles(_s(spark, sf), tag=ST.LIST_TAG, limit=50, offset=50)
    return normalize(page.withColumn("tags", F.array_join("tags", "|")))


@register("list_topics", O.with_(*BASE, TDOC, TERMS, LABELS, SIZES, TOPICS) + """
SELECT CAST(id AS BIGINT) AS id, label, size, top_terms FROM ttab WHERE id > -1
ORDER BY size DESC NULLS LAST, id LIMIT 50""")
def q_list_topics(spark, sf):
    t = ST.list_topics(ST.topics_table(spark, sf))
    return normalize(t.select("id", "label", "size", F.array_join("top_terms", ", ").alias("top_terms")))


@register("topic_samples", O.with_(*BASE) + f"""
SELECT * FROM (SELECT CAST(topic_id AS BIGINT) AS topic_id, id, title, topic_prob,
                      row_number() OVER (PARTITION BY topic_id ORDER BY topic_prob DESC, id) AS sample_rank FROM sart)
WHERE sample_rank <= {ST.SAMPLES_PER_TOPIC}""")
def q_topic_samples(spark, sf):
    return normalize(ST.topic_samples(_s(spark, sf)["articles"]))


@register("articles_with_tag", O.with_(*BASE, STAR) + f"""
SELECT id, title FROM sart WHERE id IN (SELECT article_id FROM atag JOIN tagn ON tagn.id = atag.tag_id
                                        WHERE name = '{ST.LIST_TAG}')""")
def q_articles_with_tag(spark, sf):
    return ST.articles_with_tag(_s(spark, sf), ST.LIST_TAG).select("id", "title")


@register("tag_topic_edges", O.with_(*BASE, STAR) + """
SELECT t.name AS tag, CAST(s.topic_id AS BIGINT) AS topic_id, count(*) AS weight
FROM atag a JOIN tagn t ON t.id = a.tag_id JOIN sart s ON s.id = a.article_id GROUP BY t.name, s.topic_id""")
def q_tag_topic_edges(spark, sf):
    return normalize(ST.tag_topic_edges(_s(spark, sf)))


@register("bridge_tags", O.with_(*BASE, STAR) + """,
e AS (SELECT t.name AS tag, s.topic_id, count(*) AS weight
      FROM atag a JOIN tagn t ON t.id = a.tag_id JOIN sart s ON s.id = a.article_id GROUP BY t.name, s.topic_id),
ep AS (SELECT tag, weight, CAST(weight AS DOUBLE) / sum(weight) OVER (PARTITION BY tag) AS p FROM e)
SELECT tag, count(*) AS n_topics, CAST(sum(weight) AS BIGINT) AS n_articles, round(-sum(p * ln(p)), 6) AS entropy
FROM ep GROUP BY tag""")
def q_bridge_tags(spark, sf):
    return normalize(ST.bridge_tags(ST.tag_topic_edges(_s(spark, sf))))


@register("chunk_article_join", O.with_(*BASE, O.chunks_cte()) + """
SELECT c.article_id, c.idx AS position, s.title, s.url, CAST(s.topic_id AS BIGINT) AS topic_id
FROM chunks c JOIN sart s ON s.id = c.article_id""")
def q_chunk_article_join(spark, sf):
    c = corpus.remap_chunks(corpus.chunks(spark, sf))
    a = corpus.serving_articles(spark, sf).select(F.col("id").alias("article_id"), "title", "url", "topic_id")
    return normalize(c.join(a, "article_id").select("article_id", "position", "title", "url", "topic_id"))


# ------------------------------------------------------------------ topic assignment operators

_CENT = """
ev AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
cent AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM ev WHERE label IS NOT NULL GROUP BY label, i),
cnn AS (SELECT label, sqrt(sum(m * m)) AS n FROM cent GROUP BY label),
en AS (SELECT vec_id, sqrt(sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS n FROM ev GROUP BY vec_id),
dots AS (SELECT c.label AS topic_id, e.vec_id, sum(c.m * CAST(e.v AS DOUBLE)) AS dot FROM cent c JOIN ev e USING (i) GROUP BY ALL),
cosv AS (SELECT d.vec_id, d.topic_id, round(d.dot / (cnn.n * en.n), 6) AS cosine
         FROM dots d JOIN cnn ON cnn.label = d.topic_id JOIN en USING (vec_id)),
prob AS (SELECT vec_id, topic_id, round(CASE WHEN sum(greatest(cosine, 0.0)) OVER (PARTITION BY vec_id) > 0
               THEN greatest(cosine, 0.0) / sum(greatest(cosine, 0.0)) OVER (PARTITION BY vec_id) ELSE 0.0 END, 6) AS p
         FROM cosv),
prim AS (SELECT vec_id, CAST(coalesce(label, -1) AS INTEGER) AS topic_id FROM embeddings),
asg AS (SELECT m.vec_id AS article_id, m.topic_id,
               coalesce((SELECT p FROM prob q WHERE q.vec_id = m.vec_id AND q.topic_id = m.topic_id), 0.0) AS topic_prob
        FROM prim m),
sec AS (SELECT * FROM (SELECT q.vec_id AS article_id, q.topic_id AS sec_topic_id, q.p AS sec_prob,
                              row_number() OVER (PARTITION BY q.vec_id ORDER BY q.p DESC, q.topic_id) AS sec_rank
                       FROM prob q JOIN prim m ON m.vec_id = q.vec_id WHERE q.topic_id <> m.topic_id) WHERE sec_rank <= 3)"""


def _assignments(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding", "label")
    cents = V.centroids(e.where(F.col("label").isNotNull())).select(F.col("label").alias("topic_id"), "embedding")
    probs = TP.centroid_probabilities(TP.centroid_scores(e, cents))
    primary = e.select("article_id", F.coalesce("label", F.lit(-1)).alias("topic_id"))
    return TP.secondary_topics(primary, probs)


@register("topic_assignments", "WITH " + _CENT.strip() + """
SELECT a.article_id, CAST(a.topic_id AS BIGINT) AS topic_id, a.topic_prob, s.sec_rank,
       CAST(s.sec_topic_id AS BIGINT) AS sec_topic_id, s.sec_prob
FROM asg a LEFT JOIN sec s USING (article_id)""")
def q_topic_assignments(spark, sf):
    a = _assignments(spark, sf)
    x = a.select("article_id", "topic_id", "topic_prob", F.posexplode_outer("secondary_topics").alias("p", "s"))
    return normalize(x.select("article_id", "topic_id", "topic_prob",
                              (F.col("p") + 1).cast("long").alias("sec_rank"),
                              F.col("s.topic_id").alias("sec_topic_id"), F.col("s.probability").alias("sec_prob")))


ASSIGN_THRESHOLD = 0.1


@register("assign_topics", "WITH " + _CENT.strip() + f"""
SELECT vec_id, CAST(CASE WHEN cosine >= {ASSIGN_THRESHOLD} THEN topic_id ELSE -1 END AS BIGINT) AS topic_id, cosine AS score
FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, topic_id) AS r FROM cosv) WHERE r = 1""")
def q_assign_topics(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding", "label")
    cents = V.centroids(e.where(F.col("label").isNotNull())).select(F.col("label").alias("topic_id"), "embedding")
    a = TP.assign_topics(e, cents, ASSIGN_THRESHOLD)
    return normalize(a.select(F.col("article_id").alias("vec_id"), "topic_id", "score"))


@register("placeholder_topics", "WITH " + _CENT.strip() + """
SELECT CAST(id AS BIGINT) AS id, CASE WHEN id = -1 THEN 'outlier' END AS label FROM (
  SELECT topic_id AS id FROM asg UNION SELECT sec_topic_id FROM sec)""")
def q_placeholder_topics(spark, sf):
    from lectern.operators.store import placeholder_topics
    empty = spark.createDataFrame([], "id int, label string")
    return normalize(placeholder_topics(empty, _assignments(spark, sf)))


@register("apply_topics", O.with_(*BASE) + "," + _CENT.strip() + """
SELECT s.id, CAST(coalesce(a.topic_id, s.topic_id) AS BIGINT) AS topic_id,
       CASE WHEN a.article_id IS NOT NULL THEN a.topic_prob ELSE s.topic_prob END AS topic_prob,
       CAST(coalesce((SELECT count(*) FROM sec x WHERE x.article_id = a.article_id), 0) AS BIGINT) AS n_secondary
FROM sart s LEFT JOIN asg a ON a.article_id = s.id""")
def q_apply_topics(spark, sf):
    from lectern.operators.store import apply_topics
    arts = corpus.serving_articles(spark, sf).drop("tags").withColumn(
        "secondary_topics", F.lit(None).cast("array<struct<topic_id:int,probability:double>>"))
    smap = arts.select(F.col("id").alias("source_id"), "id")
    out, _ = apply_topics(arts, _assignments(spark, sf), smap)
    return normalize(out.select("id", "topic_id", "topic_prob",
                                F.coalesce(F.size("secondary_topics"), F.lit(0)).cast("long").alias("n_secondary")))


@register("align_mismatch", O.with_(O.ART) + """
SELECT coalesce(e.vec_id, a.article_id) AS article_id,
       CASE WHEN a.article_id IS NULL THEN 'missing_text' ELSE 'missing_embedding' END AS side
FROM embeddings e FULL OUTER JOIN art a ON a.article_id = e.vec_id
WHERE e.vec_id IS NULL OR a.article_id IS NULL""")
def q_align_mismatch(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), F.lit(1).alias("_e"))
    a = corpus.raw_articles(spark, sf).select("article_id", F.lit(1).alias("_a"))
    j = e.join(a, "article_id", "full_outer").where(F.col("_e").isNull() | F.col("_a").isNull())
    return j.select("article_id", F.when(F.col("_a").isNull(), F.lit("missing_text"))
                    .otherwise(F.lit("missing_embedding")).alias("side"))


@register("align_inputs", O.with_(O.ART) + """
SELECT a.article_id, CAST(len(e.embedding) AS BIGINT) AS dim, CAST(length(a.text) AS BIGINT) AS n_chars
FROM embeddings e JOIN art a ON a.article_id = e.vec_id""")
def q_align_inputs(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")
    a = corpus.raw_articles(spark, sf).select("article_id", "text")
    return e.join(a, "article_id").select("article_id", F.size("embedding").cast("long").alias("dim"),
                                          F.length("text").cast("long").alias("n_chars"))


_ALIGN = """adoc AS (SELECT a.article_id, CAST(CASE WHEN x.cosine >= 0.1 THEN x.topic_id ELSE -1 END AS INTEGER) AS topic_id, a.text
         FROM art a JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, topic_id) AS r
                                         FROM cosv) WHERE r = 1) x ON x.vec_id = a.article_id)"""


def _assigned_docs(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding", "label")
    cents = V.centroids(e.where(F.col("label").isNotNull())).select(F.col("label").alias("topic_id"), "embedding")
    a = TP.assign_topics(e, cents, ASSIGN_THRESHOLD).select("article_id", "topic_id")
    return corpus.raw_articles(spark, sf).select("article_id", "text").join(a, "article_id")


@register("align_topics", O.with_(*BASE, TDOC, TERMS) + "," + _CENT.strip() + "," + _ALIGN + "," +
          cterms_sql("n", "adoc", "topic_id", ST.TERM_MIN_DF, 10) + """,
so AS (SELECT topic_id AS old_id, count(*) AS no FROM kterms GROUP BY topic_id),
sn AS (SELECT topic_id AS new_id, count(*) AS nn FROM nterms GROUP BY topic_id),
sh AS (SELECT o.topic_id AS old_id, n.topic_id AS new_id, count(*) AS shared FROM kterms o JOIN nterms n USING (term) GROUP BY ALL),
j AS (SELECT sh.*, round(CAST(shared AS DOUBLE) / (no + nn - shared), 6) AS jaccard FROM sh JOIN so USING (old_id) JOIN sn USING (new_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY old_id ORDER BY jaccard DESC, new_id) AS ro,
                row_number() OVER (PARTITION BY new_id ORDER BY jaccard DESC, old_id) AS rn FROM j)
SELECT CAST(old_id AS BIGINT) AS old_id, CAST(new_id AS BIGINT) AS new_id, shared, jaccard FROM r WHERE ro = 1 AND rn = 1""")
def q_align_topics(spark, sf):
    old = ST.topic_terms(spark, sf)
    new = TP.class_term_weights(_assigned_docs(spark, sf), ["topic_id"], min_df=ST.TERM_MIN_DF)
    return normalize(TP.align_topics(old, new))


PARENT_THRESHOLD = 0.1


@register("topic_parents", O.with_(*BASE, TDOC, TERMS, SIZES) + f""",
tk AS (SELECT topic_id, term, weight FROM kwt WHERE topic_id <> -1),
nrm AS (SELECT topic_id, sqrt(sum(weight * weight)) AS n FROM tk GROUP BY topic_id),
d AS (SELECT a.topic_id AS child, b.topic_id AS parent, sum(a.weight * b.weight) AS dot
      FROM tk a JOIN tk b USING (term) WHERE a.topic_id <> b.topic_id GROUP BY ALL),
c AS (SELECT d.child, d.parent, round(d.dot / (nc.n * np.n), 6) AS similarity
      FROM d JOIN nrm nc ON nc.topic_id = d.child JOIN nrm np ON np.topic_id = d.parent
      JOIN tsize sc ON sc.topic_id = d.child JOIN tsize sp ON sp.topic_id = d.parent
      WHERE sp.size > sc.size),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY child ORDER BY similarity DESC, parent) AS r
                     FROM c WHERE similarity >= {PARENT_THRESHOLD}) WHERE r = 1)
SELECT CAST(s.topic_id AS BIGINT) AS topic_id, CAST(b.parent AS BIGINT) AS parent_topic_id, b.similarity
FROM tsize s LEFT JOIN b ON b.child = s.topic_id WHERE s.topic_id <> -1""")
def q_topic_parents(spark, sf):
    weights = TP.class_term_weights(ST.topic_docs(spark, sf), ["topic_id"], min_df=ST.TERM_MIN_DF, top_n=None)
    return normalize(TP.topic_parents(weights, ST.topic_sizes(spark, sf), PARENT_THRESHOLD))


_PARENTS = f"""
tk AS (SELECT topic_id, term, weight FROM kwt WHERE topic_id <> -1),
nrm AS (SELECT topic_id, sqrt(sum(weight * weight)) AS n FROM tk GROUP BY topic_id),
d AS (SELECT a.topic_id AS child, b.topic_id AS parent, sum(a.weight * b.weight) AS dot
      FROM tk a JOIN tk b USING (term) WHERE a.topic_id <> b.topic_id GROUP BY ALL),
pc AS (SELECT d.child, d.parent, round(d.dot / (nc.n * np.n), 6) AS similarity
      FROM d JOIN nrm nc ON nc.topic_id = d.child JOIN nrm np ON np.topic_id = d.parent
      JOIN tsize sc ON sc.topic_id = d.child JOIN tsize sp ON sp.topic_id = d.parent WHERE sp.size > sc.size),
par AS (SELECT child, parent FROM (SELECT *, row_number() OVER (PARTITION BY child ORDER BY similarity DESC, parent) AS r
                                   FROM pc WHERE similarity >= {PARENT_THRESHOLD}) WHERE r = 1)"""


@register("topics_full", O.with_(*_TONE_BASE, TDOC, TERMS, LABELS, SIZES, TOPICS, _SUMMARY, _PARENTS) + """
SELECT CAST(t.id AS BIGINT) AS id, t.label, t.top_terms, CAST(t.size AS BIGINT) AS size,
       CAST(p.parent AS BIGINT) AS parent_topic_id,
       (SELECT x.tone FROM tt1 x WHERE x.topic_id = t.id ORDER BY x.mean DESC, x.tone_order LIMIT 1) AS dominant_tone
FROM ttab t LEFT JOIN par p ON p.child = t.id""")
def q_topics_full(spark, sf):
    """The topics table as the listings read it."""
    t = ST.full_topics(spark, sf)
    return normalize(t.select("id", "label", F.array_join("top_terms", ", ").alias("top_terms"), "size",
                              "parent_topic_id", "dominant_tone"))


# ------------------------------------------------------------------ rows-only: fitted models


@register("topic_fit")
def q_topic_fit(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")
    _, assignments, _ = TP.fit_topics(e, n_topics=10, min_cluster_size=TOPIC_MIN_CLUSTER_SIZE, pca_k=TP.TOPIC_PCA_COMPONENTS)
    return normalize(assignments.select("article_id", "topic_id", F.round("topic_prob", 6).alias("topic_prob"),
                                        F.size("secondary_topics").cast("long").alias("n_secondary")))


@register("pca_variance")
def q_pca_variance(spark, sf):
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")
    model, _ = TP.reduce_vectors(e, TP.TOPIC_PCA_COMPONENTS)
    ev = model.stages[-1].explainedVariance.toArray().tolist()
    return spark.createDataFrame([(i, float(round(v, 6))) for i, v in enumerate(ev)],
                                 "component long, explained_variance double")


DENSITY = (0.07, 5, 4)      # eps, points of a core neighbourhood, least size of a cluster
DENSITY_COORDS = 4


@register("density_clusters", f"""
WITH RECURSIVE p AS (SELECT vec_id AS id, list_transform(embedding[1:{DENSITY_COORDS}], lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
pair AS (SELECT a.id AS a, b.id AS b, {" + ".join(f"(a.v[{k}] - b.v[{k}]) * (a.v[{k}] - b.v[{k}])" for k in range(1, DENSITY_COORDS + 1))} AS d
         FROM p a, p b),
near AS (SELECT * FROM pair WHERE d <= {DENSITY[0]} * {DENSITY[0]}),
core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {DENSITY[1]}),
link AS (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
reach AS (SELECT id AS a, id AS b FROM core UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
lab AS (SELECT a AS id, min(b) AS label FROM reach GROUP BY a),
edge AS (SELECT a AS id, label FROM (SELECT n.a, l.label, row_number() OVER (PARTITION BY n.a ORDER BY n.d, n.b) AS r
         FROM near n JOIN lab l ON l.id = n.b WHERE n.a NOT IN (SELECT id FROM core)) WHERE r = 1),
member AS (SELECT * FROM lab UNION ALL SELECT * FROM edge),
size AS (SELECT label, count(*) AS n FROM member GROUP BY label HAVING count(*) >= {DENSITY[2]}),
numbered AS (SELECT label, row_number() OVER (ORDER BY n DESC, label) - 1 AS topic_id FROM size)
SELECT p.id AS vec_id, CAST(coalesce(x.topic_id, -1) AS BIGINT) AS topic_id, p.id IN (SELECT id FROM core) AS core
FROM p LEFT JOIN member m ON m.id = p.id LEFT JOIN numbered x ON x.label = m.label""")
def q_density_clusters(spark, sf):
    """Density clusters of the vectors' first coordinates, a space that SQL has too."""
    from lectern.operators.density import density_clusters
    e = table(spark, sf, "embeddings").select("vec_id", F.slice("embedding", 1, DENSITY_COORDS).alias("embedding"))
    return normalize(density_clusters(e, *DENSITY, id_col="vec_id"))


@register("topic_outliers")
def q_topic_outliers(spark, sf):
    """The topic of every vector, the least likely fiftieth being outliers."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("article_id"), "embedding")
    _, assignments, _ = TP.fit_topics(e, pca_k=8, outlier_share=0.02)
    return normalize(assignments.select("article_id", "topic_id"))
