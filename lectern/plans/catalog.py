"""Named queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame.

Each reads the input tables (or what Spark derives from them) in full. The
matching DuckDB SQL lives in ``ORACLES`` under the same name; column names
agree, integers are bigint and fractions double on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.config import CHUNK_OVERLAP
from lectern.operators.chunk import reconstruct_articles
from lectern.operators.windows import sentence_windows, sentences
from lectern.plans import corpus
from lectern.plans import oracle_sql as O
from lectern.plans.quote_search import quote_search
from lectern.session import written
from lectern.sources.tables import queries_table, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def normalize(df: DataFrame) -> DataFrame:
    """Widen integer types to bigint and float to double for comparison."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# ------------------------------------------------------------------ sources


@register("scan_nonblank", O.with_(O.ART) + """
SELECT article_id, url, title, author, published_at, text FROM art""")
def q_scan_nonblank(spark, sf):
    return corpus.raw_articles(spark, sf).drop("tags")


# ------------------------------------------------------------------ chunking


@register("chunk_documents", O.with_(O.ART, O.chunks_cte()) + """
SELECT article_id, title, idx, chunk_text FROM chunks""")
def q_chunk_documents(spark, sf):
    return normalize(corpus.chunks(spark, sf))


@register("reconstruct_articles", O.with_(O.ART, O.chunks_cte(), O.rebuild_cte("chunks")) + """
SELECT article_id, text, length(text)::BIGINT AS n_chars FROM rtext""")
def q_reconstruct_articles(spark, sf):
    r = reconstruct_articles(corpus.remap_chunks(corpus.chunks(spark, sf)))
    return r.select("article_id", "text", F.length("text").cast("long").alias("n_chars"))


@register("reconstruct_spans", O.with_(O.ART, O.chunks_cte(), O.rebuild_cte("chunks")) + """
SELECT article_id, position, start, "end" FROM rspan""")
def q_reconstruct_spans(spark, sf):
    r = reconstruct_articles(corpus.remap_chunks(corpus.chunks(spark, sf)))
    from lectern.operators.windows import explode_spans
    return normalize(explode_spans(r))


@register("reconstruct_conversations", O.with_(
    "conv AS (SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL)",
    O.rebuild_cte("conv", key="conv_id", pos="turn", text="text")) + """
SELECT conv_id, text FROM rtext""")
def q_reconstruct_conversations(spark, sf):
    c = table(spark, sf, "conversations").where(F.col("text").isNotNull())
    return reconstruct_articles(c, key="conv_id", position="turn", text="text").select("conv_id", "text")


# ------------------------------------------------------------------ sentences


@register("sentence_split", O.with_(O.ART, O.sentences_cte("art")) + """
SELECT article_id, sentence_index, start, "end", substr(piece, start - raw_start + 1, "end" - start) AS sentence
FROM sents""")
def q_sentence_split(spark, sf):
    s = sentences(corpus.raw_articles(spark, sf).select("article_id", "text"))
    return normalize(s.select("article_id", "sentence_index", "start", "end",
                              F.expr("substring(piece, start - raw_start + 1, `end` - start)").alias("sentence")))


@register("sentence_windows", O.with_(O.ART, O.sentences_cte("art"), O.windows_cte()) + """
SELECT article_id, window_index, window_count, first_sentence, n_sentences, start, "end", text FROM win""")
def q_sentence_windows(spark, sf):
    w = sentence_windows(sentences(corpus.raw_articles(spark, sf).select("article_id", "text")))
    return normalize(w)


# ------------------------------------------------------------------ search


def _search(spark, sf, stages=None, **options):
    # the search reads chunk vectors and chunk texts; both come from one written table
    cv = written(corpus.chunk_vectors(spark, sf), "chunk_vectors")
    arts = corpus.serving_articles(spark, sf)
    return quote_search(queries_table(spark, sf), cv, arts, stages=stages, **options)


@register("quote_shortlist", O.with_(O.ART, O.chunks_cte(), O.shortlist_cte()) + """
SELECT query_id, article_id, position, score, rank FROM sl""")
def q_quote_shortlist(spark, sf):
    from lectern.operators.encode import encode_queries
    from lectern.operators.shortlist import shortlist
    qv = encode_queries(queries_table(spark, sf))
    return normalize(shortlist(qv, corpus.chunk_vectors(spark, sf)))


_QUOTE = O.with_(O.ART, O.chunks_cte(), O.shortlist_cte(), O.quote_cte())


@register("windows_in_candidates", _QUOTE + """
SELECT query_id, article_id, window_index FROM sel""")
def q_windows_in_candidates(spark, sf):
    stages = {}
    _search(spark, sf, stages)
    return normalize(stages["selected"])


@register("capped_windows", _QUOTE + """
SELECT c.query_id, c.article_id, c.window_index, c.article_rank, h.chunk_position
FROM capped c LEFT JOIN home h USING (article_id, window_index)""")
def q_capped_windows(spark, sf):
    stages = {}
    _search(spark, sf, stages)
    return normalize(stages["capped"].select("query_id", "article_id", "window_index", "article_rank",
                                             "chunk_position"))


@register("quote_hits", _QUOTE + """
SELECT h.query_id, h.hit_rank, h.chunk_position, h.window_index, h.window_count, h.text, h.score,
       h.article_id, a.title AS article_title, a.url AS article_url, a.author,
       CAST(a.published_at AS DATE) AS published_at
FROM hits h JOIN art a USING (article_id)""")
def q_quote_hits(spark, sf):
    return normalize(_search(spark, sf))


FILTER_TOPIC = 1
FILTER_TAG = "en"


@register("quote_hits_filtered", O.with_(O.ART, O.TOPIC, f"""
fart AS (SELECT a.* FROM art a JOIN atopic t USING (article_id)
         WHERE t.topic_id = {FILTER_TOPIC} AND list_contains(a.tags, '{FILTER_TAG}'))""",
    O.chunks_cte("fart"), O.shortlist_cte(), O.quote_cte()) + """
SELECT h.query_id, h.hit_rank, h.chunk_position, h.window_index, h.text, h.score, h.article_id, a.url AS article_url
FROM hits h JOIN art a USING (article_id)""")
def q_quote_hits_filtered(spark, sf):
    """E1 with both filters: the search over the articles of a topic that have a tag."""
    tags = corpus.serving_articles(spark, sf).select(F.col("id").alias("article_id"), F.explode("tags").alias("name"))
    hits = _search(spark, sf, topic_id=FILTER_TOPIC, tag=FILTER_TAG, article_tags=tags)
    return normalize(hits.select("query_id", "hit_rank", "chunk_position", "window_index", "text", "score",
                                 "article_id", "article_url"))


@register("window_home_chunk", _QUOTE + """
SELECT article_id, window_index, chunk_position FROM home""")
def q_window_home_chunk(spark, sf):
    stages = {}
    _search(spark, sf, stages)
    return normalize(stages["home"].select("article_id", "window_index", "chunk_position").distinct())


# ------------------------------------------------------------------ scalar text functions

from lectern.functions import text as TX  # noqa: E402
from lectern.functions.ids import dense_ids  # noqa: E402
from lectern.sources import pages as PG  # noqa: E402

# Date renderings used to exercise normalize_date (Java, strftime).
DATE_RENDERINGS = (
    ("yyyy-MM-dd", "%Y-%m-%d"), ("MM/dd/yyyy", "%m/%d/%Y"), ("dd/MM/yyyy", "%d/%m/%Y"),
    ("MMMM dd, yyyy", "%B %d, %Y"), ("MMM dd yyyy", "%b %d %Y"), ("dd MMMM yyyy", "%d %B %Y"),
    ("dd MMM yyyy", "%d %b %Y"), ("yyyy/MM/dd", "%Y/%m/%d"), ("MM-dd-yyyy", "%m-%d-%Y"),
    ("yyyy", "%Y"), ("yyyyMMdd", "%Y%m%d"),
)
def _q(s: str) -> str:
    return s.replace("'", "''")


# The date formats that are accepted, in order.
_DUCK_DATE_FORMATS = ("%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%B %d, %Y", "%b %d %Y", "%d %B %Y",
                      "%d %b %Y", "%Y/%m/%d", "%m-%d-%Y")


def _rendered_dates(spark, sf):
    a = corpus.raw_articles(spark, sf).select("article_id", F.col("published_at").cast("date").alias("d"))
    arr = F.array(*[F.date_format("d", j) for j, _ in DATE_RENDERINGS])
    return a.select("article_id", F.posexplode(arr).alias("fmt", "s"))


_RENDERED_SQL = "rd AS (SELECT article_id, fmt, s FROM (SELECT article_id, CAST(published_at AS DATE) AS d FROM art), " \
    "LATERAL (SELECT unnest(range(0, {n})) AS fmt, unnest([{parts}]) AS s))".format(
        n=len(DATE_RENDERINGS), parts=", ".join(f"strftime(d, '{c}')" for _, c in DATE_RENDERINGS))

_GUARD = "regexp_matches(s, '(^|[^0-9])[0-9]{4}([^0-9]|$)') AND NOT regexp_matches(s, '^[0-9]{4}$')"
_NORM_DATE_SQL = ("CASE WHEN s IS NULL OR s = '' THEN '' ELSE coalesce(CASE WHEN " + _GUARD
                  + " THEN strftime(coalesce(" + ", ".join(f"try_strptime(s, '{f}')" for f in _DUCK_DATE_FORMATS)
                  + "), '%Y-%m-%d') END, '') END")


@register("normalize_date", O.with_(O.ART, _RENDERED_SQL) + f"""
SELECT article_id, fmt, s AS raw, {_NORM_DATE_SQL} AS normalized FROM rd""")
def q_normalize_date(spark, sf):
    r = _rendered_dates(spark, sf)
    return normalize(r.select("article_id", "fmt", F.col("s").alias("raw"),
                              TX.normalize_date(F.col("s")).alias("normalized")))


@register("parse_published_at", O.with_(O.ART, _RENDERED_SQL) + f"""
SELECT article_id, fmt, s AS raw,
       CASE WHEN regexp_matches(substr(trim(s, {O.WS}), 1, 10), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
            THEN CAST(try_strptime(substr(trim(s, {O.WS}), 1, 10), '%Y-%m-%d') AS DATE)
            WHEN regexp_matches(substr(trim(s, {O.WS}), 1, 10), '^[0-9]{{8}}$')
            THEN CAST(try_strptime(substr(trim(s, {O.WS}), 1, 10), '%Y%m%d') AS DATE) END AS published_at
FROM rd""")
def q_parse_published_at(spark, sf):
    r = _rendered_dates(spark, sf)
    return normalize(r.select("article_id", "fmt", F.col("s").alias("raw"),
                              TX.parse_published_at(F.col("s")).alias("published_at")))


@register("normalize_text", f"""
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN '' ELSE
  trim(regexp_replace(replace(regexp_replace(text, '^---\\s*\\n(?s:.*?)\\n---\\s*\\n', ''), chr(10), ' '),
                      '[ \\t]+', ' ', 'g'), {O.WS}) END AS text
FROM documents""")
def q_normalize_text(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", TX.normalize_text(F.col("text")).alias("text"))


_TITLE_SQL = "trim(" + "".join("replace(" for _ in PG.ENTITIES) + \
    "regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)" + \
    "".join(f", '{e}', '{_q(c)}')" for e, c in PG.ENTITIES) + f", {O.WS})"


# A parser also reads an entity that the end of the title cuts off.
_PARSED_TITLE_SQL = f"regexp_replace({_TITLE_SQL}, '&amp$', '&')"


@register("extract_title", f"SELECT page_id, {_TITLE_SQL} AS title FROM pages")
def q_extract_title(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", PG.title_from_html(F.col("html")).alias("title"))


@register("normalize_title", f"""
SELECT page_id, CASE WHEN t IS NULL OR t = '' THEN '' ELSE trim(split_part(t, '|', 1), {O.WS}) END AS title
FROM (SELECT page_id, {_TITLE_SQL} AS t FROM pages
      UNION ALL SELECT -1 - doc_id, source || ' ' || CAST(doc_id AS VARCHAR) || ' | corpus' FROM documents)""")
def q_normalize_title(spark, sf):
    p = table(spark, sf, "pages").select("page_id", PG.title_from_html(F.col("html")).alias("t"))
    d = table(spark, sf, "documents").select(
        (F.lit(-1) - F.col("doc_id")).alias("page_id"),
        F.concat("source", F.lit(" "), F.col("doc_id").cast("string"), F.lit(" | corpus")).alias("t"))
    return p.unionByName(d).select("page_id", TX.normalize_title(F.col("t")).alias("title"))


@register("content_hash", "SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL")
def q_content_hash(spark, sf):
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    return d.select("doc_id", TX.content_hash(F.col("text")).alias("content_hash"))


@register("normalize_tags", f"""
SELECT doc_id, array_to_string(tg, '|') AS tags, CAST(len(tg) AS BIGINT) AS n_tags FROM (
  SELECT doc_id, list_filter(list_transform([lang, ' ' || source || ' ', '', NULL::VARCHAR, lang, chr(9)],
                                            lambda t: trim(t, {O.WS})),
                             lambda t: t IS NOT NULL AND t <> '') AS tg FROM documents)""")
def q_normalize_tags(spark, sf):
    d = table(spark, sf, "documents")
    raw = F.array("lang", F.concat(F.lit(" "), "source", F.lit(" ")), F.lit(""),
                  F.lit(None).cast("string"), "lang", F.lit("\t"))
    t = TX.normalize_tags(raw)
    return d.select("doc_id", F.array_join(t, "|").alias("tags"), F.size(t).cast("long").alias("n_tags"))


@register("article_url_filter", """
SELECT page_id, url FROM pages WHERE contains(url, '/en/') AND NOT ends_with(rtrim(url, '/'), '/en')""")
def q_article_url_filter(spark, sf):
    p = table(spark, sf, "pages")
    return p.where(TX.is_article_url(F.col("url"), "en")).select("page_id", "url")


@register("assign_ids", O.with_(O.ART) + """
SELECT url, row_number() OVER (ORDER BY url) AS id FROM (SELECT url FROM art UNION SELECT url FROM pages)""")
def q_assign_ids(spark, sf):
    urls = corpus.raw_articles(spark, sf).select("url").union(table(spark, sf, "pages").select("url")).distinct()
    return dense_ids(urls, "url")


@register("pair_overlap", O.with_(O.ART, O.chunks_cte()) + """
SELECT a.article_id, a.idx, CAST(coalesce(list_filter(range(least(160, length(a.chunk_text), length(b.chunk_text)), 0, -1),
         lambda n: right(a.chunk_text, n) = left(b.chunk_text, n))[1], 0) AS BIGINT) AS overlap
FROM chunks a JOIN chunks b ON b.article_id = a.article_id AND b.idx = a.idx + 1""")
def q_pair_overlap(spark, sf):
    # only a chunk's first and last characters can overlap; both sides of the join read what was cut once
    c = written(corpus.chunks(spark, sf).select("article_id", "idx", F.left("chunk_text", F.lit(CHUNK_OVERLAP)).alias("head"),
                                                F.right("chunk_text", F.lit(CHUNK_OVERLAP)).alias("tail")), "chunk_ends")
    n = c.select("article_id", (F.col("idx") - 1).alias("idx"), F.col("head").alias("next_head"))
    j = c.select("article_id", "idx", "tail").join(n, ["article_id", "idx"])
    return normalize(j.select("article_id", "idx",
                              TX.longest_overlap(F.col("tail"), F.col("next_head")).cast("long").alias("overlap")))


@register("chunk_remap", O.with_(O.ART, O.chunks_cte()) + """
SELECT article_id, idx AS position, chunk_text AS text FROM chunks""")
def q_chunk_remap(spark, sf):
    return normalize(corpus.remap_chunks(corpus.chunks(spark, sf)))


_BODY_SQL = "array_to_string(list_filter(list_transform(regexp_split_to_array(regexp_extract(" \
    "regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), " \
    "'(?s)<(script|style)[^>]*>.*?</(script|style)>', '', 'g'), '(?s)<article[^>]*>(.*)</article>', 1), " \
    "'<[^>]*>'), lambda x: trim(regexp_replace(" + "".join("replace(" for _ in PG.ENTITIES) + "x" + \
    "".join(f", '{e}', '{_q(c)}')" for e, c in PG.ENTITIES) + f", '&amp$', '&'), {O.WS})), lambda x: x <> ''), ' ')"


@register("extract_article", f"""
SELECT page_id, url, {_PARSED_TITLE_SQL} AS title, {_BODY_SQL} AS text,
       nullif(regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1), '') AS lang FROM pages""")
def q_extract_article(spark, sf):
    a = PG.extract_articles(table(spark, sf, "pages"))
    return a.select("page_id", "url", "title", "text", "lang")


# ------------------------------------------------------------------ vectors

from lectern.operators import vectors as V  # noqa: E402
from lectern.operators import tone as TN  # noqa: E402


@register("encode_chunks", O.with_(O.ART, O.chunks_cte(), O.encode_cte("cvec", "chunks", "article_id, idx", "chunk_text")) + """
SELECT article_id, idx AS position, CAST(b AS BIGINT) AS dim, CAST(w AS DOUBLE) AS value FROM cvec""")
def q_encode_chunks(spark, sf):
    cv = corpus.chunk_vectors(spark, sf)
    return normalize(V.explode_vector(cv, ["article_id", "position"]))


@register("vector_topk", """
WITH ev AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
cent AS (SELECT label, i, avg(CAST(v AS DOUBLE)) AS m FROM ev WHERE label IS NOT NULL GROUP BY label, i),
cnn AS (SELECT label, sqrt(sum(m * m)) AS n FROM cent GROUP BY label),
en AS (SELECT vec_id, sqrt(sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS n FROM ev GROUP BY vec_id),
dots AS (SELECT c.label, e.vec_id, sum(c.m * CAST(e.v AS DOUBLE)) AS dot FROM cent c JOIN ev e USING (i) GROUP BY ALL),
sims AS (SELECT d.label, d.vec_id, round(d.dot / (cnn.n * en.n), 6) AS score
         FROM dots d JOIN cnn USING (label) JOIN en USING (vec_id)),
top AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM sims)
SELECT CAST(label AS BIGINT) AS label, vec_id, score, rank FROM top WHERE rank <= 50""")
def q_vector_topk(spark, sf):
    return normalize(V.vector_topk(table(spark, sf, "embeddings")))


@register("mean_pool", O.with_(O.ART, O.chunks_cte(), O.encode_cte("cvec", "chunks", "article_id, idx", "chunk_text")) + """,
nch AS (SELECT article_id, count(*) AS n FROM chunks GROUP BY article_id),
pool AS (SELECT c.article_id, c.b AS dim, CAST(sum(CAST(c.w AS DOUBLE)) / any_value(n.n) AS FLOAT) AS value
         FROM cvec c JOIN nch n USING (article_id) GROUP BY c.article_id, c.b)
SELECT article_id, CAST(dim AS BIGINT) AS dim, round(CAST(value AS DOUBLE), 6) AS value FROM pool WHERE value <> 0""")
def q_mean_pool(spark, sf):
    pooled = V.mean_pool(corpus.chunk_vectors(spark, sf))
    e = V.explode_vector(pooled, ["article_id"])
    return normalize(e.select("article_id", "dim", F.round("value", 6).alias("value")))


# ------------------------------------------------------------------ tone

_TW_SQL = """
tw AS (SELECT article_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS t FROM art),
tw2 AS (SELECT article_id, t, unnest(range(0, len(t), 384)) AS s,
               generate_subscripts(range(0, len(t), 384), 1) - 1 AS window_index FROM tw),
twin AS (SELECT article_id, CAST(window_index AS BIGINT) AS window_index,
                CAST(len(list_slice(t, s + 1, s + 384)) AS BIGINT) AS n_tokens,
                array_to_string(list_slice(t, s + 1, s + 384), ' ') AS text FROM tw2)"""


@register("token_windows", O.with_(O.ART, _TW_SQL) + """
SELECT article_id, window_index, n_tokens, text FROM twin""")
def q_token_windows(spark, sf):
    return normalize(TN.token_windows(corpus.raw_articles(spark, sf)))


def _lex_sql():
    rows = ", ".join(f"('{w}', '{lb}')" for lb, ws in corpus.TONE_WORDS.items() for w in ws)
    return f"lex(word, label) AS (VALUES {rows})"


_SCORED_SQL = f""",
wt AS (SELECT article_id, window_index, n_tokens, regexp_extract_all(lower(text), '{O.TOK}') AS w FROM twin),
hits AS (SELECT article_id, window_index, label, count(*) AS h
         FROM (SELECT article_id, window_index, unnest(w) AS word FROM wt) JOIN lex USING (word) GROUP BY ALL),
ws AS (SELECT wt.article_id, wt.window_index, wt.n_tokens, l.label,
              CASE WHEN len(wt.w) > 0 THEN CAST(coalesce(h.h, 0) AS DOUBLE) / len(wt.w) ELSE 0.0 END AS score
       FROM wt CROSS JOIN (SELECT DISTINCT label FROM lex) l
       LEFT JOIN hits h ON h.article_id = wt.article_id AND h.window_index = wt.window_index AND h.label = l.label),
tone AS (SELECT article_id,
  sum(CASE WHEN label = 'academic' THEN score * n_tokens END) / sum(CASE WHEN label = 'academic' THEN n_tokens END) AS academic,
  sum(CASE WHEN label = 'militant' THEN score * n_tokens END) / sum(CASE WHEN label = 'militant' THEN n_tokens END) AS militant,
  sum(CASE WHEN label = 'hopeful' THEN score * n_tokens END) / sum(CASE WHEN label = 'hopeful' THEN n_tokens END) AS hopeful,
  sum(CASE WHEN label = 'critical' THEN score * n_tokens END) / sum(CASE WHEN label = 'critical' THEN n_tokens END) AS critical
  FROM ws GROUP BY article_id)"""

_TONE_SQL = _lex_sql() + _SCORED_SQL


def _round_tone(df):
    return df.select("article_id", *[F.round(lb, 6).alias(lb) for lb in ("academic", "militant", "hopeful", "critical")])


@register("tone_scores", O.with_(O.ART, _TW_SQL, _TONE_SQL) + """
SELECT article_id, round(academic, 6) AS academic, round(militant, 6) AS militant,
       round(hopeful, 6) AS hopeful, round(critical, 6) AS critical FROM tone""")
def q_tone_scores(spark, sf):
    return _round_tone(TN.score_articles(corpus.raw_articles(spark, sf), lexicon=corpus.TONE_WORDS))


_SEED_ROWS = ", ".join(f"('{w}', '{lb}')" for lb, ws in corpus.TONE_SEEDS.items() for w in ws)
_LEARNED_SQL = f"""
seed(word, label) AS (VALUES {_SEED_ROWS}),
unit AS (SELECT article_id, window_index, list_distinct(regexp_extract_all(lower(text), '{O.TOK}')) AS w FROM twin),
mark AS (SELECT article_id, window_index, label, list_has_any(w, words) AS f
         FROM unit CROSS JOIN (SELECT label, list(word) AS words FROM seed GROUP BY label)),
total AS (SELECT label, count(*) AS n, count(*) FILTER (f) AS n_in FROM mark GROUP BY label),
pair AS (SELECT word, label, count(*) AS n_word, count(*) FILTER (f) AS n_windows
         FROM (SELECT article_id, window_index, unnest(w) AS word FROM unit) JOIN mark USING (article_id, window_index)
         GROUP BY word, label),
assoc AS (SELECT label, word, n_windows,
                 round(ln((n_windows + 1.0) / (n_in + 2.0)) - ln((n_word - n_windows + 1.0) / (n - n_in + 2.0)), 6) AS score
          FROM pair JOIN total USING (label)
          WHERE n_windows >= {TN.LEARNED_WINDOWS} AND length(word) >= {TN.LEARNED_CHARS} AND word NOT IN (SELECT word FROM seed)),
learned AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, word) AS rank
                           FROM assoc WHERE score > 0) WHERE rank <= {TN.LEARNED_WORDS})"""


@register("tone_words", O.with_(O.ART, _TW_SQL, _LEARNED_SQL) + """
SELECT label, word, n_windows, score, rank FROM learned""")
def q_tone_words(spark, sf):
    return normalize(TN.learn_tone_words(TN.token_windows(corpus.raw_articles(spark, sf)), corpus.TONE_SEEDS))


@register("tone_scores_learned", O.with_(O.ART, _TW_SQL, _LEARNED_SQL, """
lex AS (SELECT word, label FROM seed UNION SELECT word, label FROM learned)""" + _SCORED_SQL) + """
SELECT article_id, round(academic, 6) AS academic, round(militant, 6) AS militant,
       round(hopeful, 6) AS hopeful, round(critical, 6) AS critical FROM tone""")
def q_tone_scores_learned(spark, sf):
    """The tone of all articles by seeds and the words learned from them."""
    windows = written(TN.token_windows(corpus.raw_articles(spark, sf)), "token_windows")
    lexicon = TN.learned_lexicon(TN.learn_tone_words(windows, corpus.TONE_SEEDS), corpus.TONE_SEEDS)
    return _round_tone(TN.tone_scores(TN.lexical_window_scores(windows, lexicon)))


# more registrations live in sibling modules; importing them fills QUERIES / ORACLES
from lectern.plans import catalog_views  # noqa: E402,F401
from lectern.plans import catalog_store  # noqa: E402,F401
from lectern.plans import catalog_quality  # noqa: E402,F401
from lectern.plans import catalog_search  # noqa: E402,F401
