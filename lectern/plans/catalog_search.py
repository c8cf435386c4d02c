"""Registered queries for full-text search, retrieval evaluation, the IVF
shortlist and the streaming ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lectern.operators import bm25 as BM
from lectern.operators import shortlist as SL
from lectern.operators import textindex as TI
from lectern.operators.encode import encode_chunks, encode_queries
from lectern.operators.latent import fit_latent
from lectern.functions.tokens import TOKEN_PATTERN
from lectern.plans import corpus, evaluation as EV
from lectern.plans import oracle_sql as O
from lectern.plans.catalog import _QUOTE, _TONE_SQL, _TW_SQL, _search, normalize, register
from lectern.plans.catalog_views import STOP_SQL
from lectern.plans.quote_search import quote_search
from lectern.config import IVFFLAT_LISTS, IVFFLAT_PROBES, TONE_LABELS
from lectern.session import discard, ensure_checkpoint_dir, written
from lectern.sources.tables import queries_table

_TP = f"""tp AS (SELECT article_id, unnest(regexp_extract_all(lower(text), '{O.TOK}')) AS term,
               generate_subscripts(regexp_extract_all(lower(text), '{O.TOK}'), 1) AS pos FROM art),
post AS (SELECT term, article_id, count(*) AS tf, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS positions
         FROM tp WHERE NOT list_contains({STOP_SQL}, term) GROUP BY term, article_id)"""


@register("text_postings", O.with_(O.ART, _TP) + "SELECT term, article_id, tf, positions FROM post")
def q_text_postings(spark, sf):
    p = TI.postings(corpus.raw_articles(spark, sf))
    return p.select("term", "article_id", "tf", F.array_join(F.transform("positions", lambda x: x.cast("string")),
                                                             ",").alias("positions"))


SEARCH_TOP = 10


_SEARCH_SQL = f""",
qt AS (SELECT item_id AS query_id, unnest(list_distinct(list_filter(regexp_extract_all(lower(text), '{O.TOK}'),
                                            lambda t: NOT list_contains({STOP_SQL}, t)))) AS term FROM benchmark),
dfq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
nd AS (SELECT count(DISTINCT article_id) AS n FROM post),
sc AS (SELECT q.query_id, p.article_id, round(sum(p.tf * ln(CAST((SELECT n FROM nd) AS DOUBLE) / d.df)), 6) AS score,
              count(*) AS matched
       FROM qt q JOIN post p USING (term) JOIN dfq d USING (term) GROUP BY q.query_id, p.article_id)
SELECT * FROM (SELECT query_id, article_id, score, matched,
                      row_number() OVER (PARTITION BY query_id ORDER BY score DESC, article_id) AS rank FROM sc)
WHERE rank <= {SEARCH_TOP}"""


@register("text_search", O.with_(O.ART, _TP) + _SEARCH_SQL)
def q_text_search(spark, sf):
    # the index is written once; hits, frequencies and the document count read its columns
    post = written(TI.postings(corpus.raw_articles(spark, sf)), "postings")
    return normalize(TI.search(queries_table(spark, sf), post, top=SEARCH_TOP))


@register("text_search_blocks", O.with_(O.ART, _TP) + _SEARCH_SQL)
def q_text_search_blocks(spark, sf):
    """The same hits from postings in blocks, most of which are never read."""
    post = written(TI.postings(corpus.raw_articles(spark, sf)), "postings")
    blocks = written(TI.block_postings(post), "blocks")
    n = post.select("article_id").distinct().count()
    return normalize(TI.search_blocks(queries_table(spark, sf), blocks, n, top=SEARCH_TOP))


PHRASE_WORDS = 4


@register("phrase_search", O.with_(O.ART, _TP) + f""",
ph AS (SELECT item_id AS query_id, list_slice(regexp_extract_all(lower(text), '{O.TOK}'), 1, {PHRASE_WORDS}) AS w FROM benchmark),
asked AS (SELECT query_id, w FROM ph WHERE len(list_filter(w, lambda t: NOT list_contains({STOP_SQL}, t))) > 0),
doc AS (SELECT article_id, regexp_extract_all(lower(text), '{O.TOK}') AS t FROM art),
word AS (SELECT query_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS off FROM asked),
kept AS (SELECT * FROM word WHERE NOT list_contains({STOP_SQL}, term)),
need AS (SELECT query_id, count(*) AS n FROM kept GROUP BY query_id),
place AS (SELECT article_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM doc),
start AS (SELECT k.query_id, p.article_id, p.pos - k.off AS s FROM kept k JOIN place p USING (term)
          GROUP BY k.query_id, p.article_id, p.pos - k.off
          HAVING count(*) = (SELECT n FROM need WHERE need.query_id = k.query_id) AND p.pos - k.off >= 1)
SELECT * FROM (SELECT query_id, article_id, count(*) AS occurrences, min(s) AS first_position,
                      row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, article_id) AS rank
               FROM start GROUP BY query_id, article_id) WHERE rank <= {SEARCH_TOP}""")
def q_phrase_search(spark, sf):
    """Articles that hold the first words of a benchmark item in a row."""
    q = queries_table(spark, sf)
    q = q.select("query_id", F.array_join(F.slice(F.regexp_extract_all(F.lower("query"), F.lit(TOKEN_PATTERN), 0), 1, PHRASE_WORDS), " ").alias("query"))
    post = written(TI.postings(corpus.raw_articles(spark, sf)), "postings")
    return normalize(TI.phrase_search(q, post, top=SEARCH_TOP))


@register("eval_hits", _QUOTE + f""",
rel AS (SELECT h.query_id, min(h.hit_rank) AS first_relevant FROM hits h JOIN art a USING (article_id)
        JOIN qry q ON q.query_id = h.query_id WHERE contains(a.text, q.query) GROUP BY h.query_id)
SELECT b.item_id AS query_id, r.first_relevant, CAST(r.first_relevant IS NOT NULL AS BIGINT) AS hit_at_k,
       round(coalesce(1.0 / r.first_relevant, 0.0), 6) AS reciprocal_rank
FROM benchmark b LEFT JOIN rel r ON r.query_id = b.item_id""")
def q_eval_hits(spark, sf):
    hits = _search(spark, sf)
    return EV.eval_hits(hits, queries_table(spark, sf), corpus.serving_articles(spark, sf))


@register("eval_hits_latent")
def q_eval_hits_latent(spark, sf):
    """The evaluation with vectors of the encoder trained on all chunks (no SQL form:
    pytest holds the model against plain numpy)."""
    scratch: list[str] = []
    made = written(corpus.chunks(spark, sf), "chunks", scratch)
    encoder = fit_latent(made, "chunk_text").encoder(spark)
    cv = written(corpus.remap_chunks(encode_chunks(made, encoder)), "chunk_vectors")
    discard(spark, scratch)
    arts = corpus.serving_articles(spark, sf)
    hits = quote_search(queries_table(spark, sf), cv, arts, encoder_factory=encoder)
    return EV.eval_hits(hits, queries_table(spark, sf), arts)


@register("candidate_chunks", O.with_(O.ART, O.chunks_cte(), O.shortlist_cte()) + """
SELECT article_id, idx AS position FROM chunks WHERE article_id IN (SELECT article_id FROM sl)""")
def q_candidate_chunks(spark, sf):
    stages = {}
    _search(spark, sf, stages)
    return normalize(stages["fetched"].select("article_id", "position"))


@register("quote_hits_bm25", O.with_(O.ART, O.chunks_cte(), O.shortlist_cte(), O.quote_cte(
    scorer=O.bm25_cte(BM.K1, BM.B, BM.PROXIMITY), score="bm.score")) + """
SELECT h.query_id, h.hit_rank, h.chunk_position, h.window_index, h.text, h.score, h.article_id, a.url AS article_url
FROM hits h JOIN art a USING (article_id)""")
def q_quote_hits_bm25(spark, sf):
    """E1 with windows scored by BM25 and proximity, from statistics of all chunks."""
    cv = written(corpus.chunk_vectors(spark, sf), "chunk_vectors")
    hits = quote_search(queries_table(spark, sf), cv, corpus.serving_articles(spark, sf),
                        statistics=BM.corpus_statistics(cv))
    return normalize(hits.select("query_id", "hit_rank", "chunk_position", "window_index", "text", "score",
                                 "article_id", "article_url"))


# Registered twice: the default number of lists and probes, and fewer of both.
IVF_FEW = (16, 4)


def _ivf_recall(spark, sf, lists: int, probes: int):
    cv = written(corpus.chunk_vectors(spark, sf).select("article_id", "position", "embedding"), "chunk_vectors")
    qv = encode_queries(queries_table(spark, sf))
    cents, folder = SL.write_lists(cv, lists)
    approx = SL.ivf_shortlist(qv, spark.read.parquet(folder), cents, probes=probes)
    exact = SL.shortlist(qv, cv)
    inter = approx.join(exact, ["query_id", "article_id", "position"]).groupBy("query_id").count()
    return exact.select("query_id").distinct().join(inter, "query_id", "left").select(
        "query_id", F.round(F.coalesce(F.col("count"), F.lit(0)) / SL.RETRIEVAL_CANDIDATES, 6).alias("recall"))


@register("ivf_recall")
def q_ivf_recall(spark, sf):
    return _ivf_recall(spark, sf, IVFFLAT_LISTS, IVFFLAT_PROBES)


@register("ivf_recall_few")
def q_ivf_recall_few(spark, sf):
    return _ivf_recall(spark, sf, *IVF_FEW)


_INGEST_SQL = O.with_(
    O.ART, O.TOPIC, O.chunks_cte(), O.encode_cte("cvec", "chunks", "article_id, idx", "chunk_text"), """
nch AS (SELECT article_id, count(*) AS n FROM chunks GROUP BY article_id),
pool AS (SELECT c.article_id, c.b, CAST(sum(CAST(c.w AS DOUBLE)) / any_value(n.n) AS FLOAT) AS v
         FROM cvec c JOIN nch n USING (article_id) GROUP BY c.article_id, c.b),
lab AS (SELECT article_id, topic_id FROM atopic WHERE topic_id >= 0),
labn AS (SELECT topic_id, count(*) AS n FROM lab GROUP BY topic_id),
cent AS (SELECT topic_id, b, sum(CAST(v AS DOUBLE)) / any_value(labn.n) AS m
         FROM pool JOIN lab USING (article_id) JOIN labn USING (topic_id) GROUP BY topic_id, b),
cnn AS (SELECT topic_id, sqrt(sum(m * m)) AS n FROM cent GROUP BY topic_id),
pn AS (SELECT article_id, sqrt(sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS n FROM pool GROUP BY article_id),
dot AS (SELECT p.article_id, c.topic_id, sum(c.m * CAST(p.v AS DOUBLE)) AS d FROM pool p JOIN cent c USING (b) GROUP BY ALL),
best AS (SELECT * FROM (SELECT article_id, topic_id, round(d / (pn.n * cnn.n), 6) AS cosine,
                               row_number() OVER (PARTITION BY article_id ORDER BY round(d / (pn.n * cnn.n), 6) DESC, topic_id) AS r
                        FROM dot JOIN pn USING (article_id) JOIN cnn USING (topic_id)) WHERE r = 1),
loaded AS (SELECT a.article_id, trim(a.url, """ + O.WS + """) AS url, sha256(a.text) AS content_hash, a.tags,
                  CAST(CASE WHEN b.cosine >= 0.1 THEN b.topic_id ELSE -1 END AS BIGINT) AS topic_id
           FROM art a LEFT JOIN best b USING (article_id))""")


LANDINGS = 2                # times that new shards land


def _ingested(spark, sf):
    """Land the raw articles in several goes, in the order of urls, each as several
    shards, and stream every landing into a store as one micro-batch; then stream
    them all once more, which finds nothing new. Topics come from centroids saved
    beforehand."""
    from lectern.operators.buckets import read_store
    from lectern.operators.vectors import centroids, mean_pool
    from lectern.sources.files import write_raw_shards
    from lectern.sources.tables import topic_of_article
    from lectern.streaming.ingest import start_ingest
    labelled = written(topic_of_article(spark, sf).where("topic_id >= 0"), "labelled_articles")
    # only labelled articles count for a centroid: the others are not chunked and encoded for it
    saved = written(centroids(mean_pool(corpus.chunk_vectors(spark, sf, of=labelled)).join(labelled, "article_id"), "topic_id"),
                    "saved_centroids")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex[:12]}"
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = corpus.raw_articles(spark, sf)

    def ingest(run: str, max_files: int) -> None:
        start_ingest(spark, f"{base}/landing/*", f"{base}/store", f"{base}/checkpoint-{run}", saved,
                     lexicon=corpus.TONE_WORDS, max_files=max_files).awaitTermination()
    # a url's landing is its place among the ranges, so that ids follow the order of urls over all landings
    key = F.trim("url")
    ranges = max(shards, LANDINGS)
    placed = raw.select(key.alias("_url")).repartitionByRange(ranges, "_url").select("_url", F.spark_partition_id().alias("_p"))
    ends = {r["_p"]: r["top"] for r in placed.groupBy("_p").agg(F.max("_url").alias("top")).collect()}   # a row a range
    tops = [max((top for p, top in ends.items() if p < ranges * (k + 1) // LANDINGS and top is not None), default=None)
            for k in range(LANDINGS - 1)]
    for k in range(LANDINGS):
        own = raw
        if k and tops[k - 1] is not None:
            own = own.where(key > tops[k - 1])
        if k < LANDINGS - 1:
            own = own.where(key.isNull() | (key <= tops[k])) if tops[k] is not None else own.where(key.isNull())
        # files without a limit of rows: a landing has as many as shards, at most
        write_raw_shards(own.repartition(shards, "url"), f"{base}/landing/{k}", rows_per_file=0)
        ingest("first", shards)
    ingest("again", shards)
    return read_store(spark, f"{base}/store")


@register("incremental_ingest", _INGEST_SQL + f"""
SELECT row_number() OVER (ORDER BY url) AS id, url, content_hash, topic_id FROM loaded""")
def q_incremental_ingest(spark, sf):
    """E5: the store after a stream of micro-batches and a replay, with every id: they
    are dense, and as articles land in the order of urls, they follow it."""
    return normalize(_ingested(spark, sf)["articles"].select("id", "url", "content_hash", "topic_id"))


@register("ingest_views", _INGEST_SQL + "," + _TW_SQL + "," + _TONE_SQL + """
SELECT 'tag' AS view, name AS key, count(*) AS n_articles, """ + ", ".join(f"CAST(NULL AS DOUBLE) AS mean_{lb}" for lb in TONE_LABELS) + """
FROM (SELECT DISTINCT url, unnest(tags) AS name FROM loaded) GROUP BY name
UNION ALL
SELECT 'topic', CAST(topic_id AS VARCHAR), count(*), """ + ", ".join(f"round(avg(round(t.{lb}, 6)), 6)" for lb in TONE_LABELS) + """
FROM loaded JOIN tone t USING (article_id) GROUP BY topic_id""")
def q_ingest_views(spark, sf):
    """E5: the views that each micro-batch changes by its deltas, against a recomputation."""
    from lectern.operators.buckets import tag_frequency, topic_tone_means
    store = _ingested(spark, sf)
    none = [F.lit(None).cast("double").alias(f"mean_{lb}") for lb in TONE_LABELS]
    tags = tag_frequency(store).select(F.lit("tag").alias("view"), F.col("name").alias("key"), "n_articles", *none)
    topics = topic_tone_means(store).select(F.lit("topic").alias("view"), F.col("topic_id").cast("string").alias("key"),
                                            "n_articles", *[f"mean_{lb}" for lb in TONE_LABELS])
    return tags.unionByName(topics)
