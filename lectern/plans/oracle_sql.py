"""DuckDB SQL that computes the same results as the registered Spark queries.

These are independent restatements of each operator's rule in plain SQL,
run by the driver against the same Parquet tables at sf0.01. They are
composed from the CTE fragments below, so every oracle uses the same
article view, chunk rule and encoder.
"""

from __future__ import annotations

from lectern.config import (CHUNK_OVERLAP, CHUNK_SIZE, DEFAULT_RESULT_LIMIT, EMBEDDING_DIMENSION,
                            RERANK_MAX_WINDOWS, RETRIEVAL_CANDIDATES)
from lectern.functions.tokens import HASH_HEX_DIGITS, TOKEN_PATTERN
from lectern.operators.windows import SENTENCE_PATTERN
from lectern.sources.tables import DATE_SPAN_DAYS, EPOCH, TITLE_SUFFIX, URL_PREFIX

WS = "' ' || chr(10) || chr(9) || chr(13) || chr(11) || chr(12)"
SENT = SENTENCE_PATTERN.replace("'", "''")
TOK = TOKEN_PATTERN

ART = f"""
art AS (
  SELECT doc_id AS article_id,
         '{URL_PREFIX}' || source || '-' || CAST(doc_id AS VARCHAR) AS url,
         source || ' ' || CAST(doc_id AS VARCHAR) || '{TITLE_SUFFIX}' AS title,
         source AS author,
         CAST(CAST(DATE '{EPOCH}' + CAST(doc_id % {DATE_SPAN_DAYS} AS INTEGER) AS DATE) AS VARCHAR) AS published_at,
         text, [lang, source] AS tags
  FROM documents
  WHERE text IS NOT NULL AND trim(text) <> '')"""

TOPIC = """
atopic AS (
  SELECT a.article_id, CAST(coalesce(e.label, -1) AS INTEGER) AS topic_id
  FROM art a LEFT JOIN embeddings e ON e.vec_id = a.article_id)"""

SERVING = """
sart AS (
  SELECT a.article_id AS id, trim(a.url) AS url, sha256(a.text) AS content_hash, a.title, a.author,
         CAST(a.published_at AS DATE) AS published_at, a.text AS body, t.topic_id,
         CAST(CASE WHEN t.topic_id = -1 THEN 0.0 ELSE 1.0 END AS DOUBLE) AS topic_prob, a.tags
  FROM art a JOIN atopic t USING (article_id))"""


def chunks_cte(source: str = "art", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, p: str = "") -> str:
    """G1 as a recursive CTE over packed word pieces (prefix sums of lengths)."""
    return f"""
{p}w AS (
  SELECT article_id, title, unnest(regexp_extract_all(text, '^[^ ]+| [^ ]*')) AS pc,
         generate_subscripts(regexp_extract_all(text, '^[^ ]+| [^ ]*'), 1) AS i
  FROM {source}),
{p}cw AS (SELECT article_id, title, i, pc, length(pc) AS l,
              sum(length(pc)) OVER (PARTITION BY article_id ORDER BY i) AS cum FROM {p}w),
{p}dw AS (SELECT article_id, any_value(title) AS title, list(cum ORDER BY i) AS cum, list(l ORDER BY i) AS ls,
              list(pc ORDER BY i) AS pcs FROM {p}cw GROUP BY article_id),
{p}rw AS (
  SELECT article_id, title, 1::BIGINT AS s,
         len(list_filter(cum, lambda x: x <= {size}))::BIGINT AS e, cum, ls, pcs, 0 AS k FROM {p}dw
  UNION ALL
  SELECT article_id, title, s2,
         len(list_filter(cum, lambda x: x <= (CASE WHEN s2 > 1 THEN cum[s2-1] ELSE 0 END) + {size}))::BIGINT,
         cum, ls, pcs, k + 1
  FROM (SELECT *, 1 + len(list_filter(list_prepend(0, cum),
                 lambda x: x < cum[e]-{overlap} OR x < cum[e]+ls[e+1]-{size}))::BIGINT AS s2
        FROM {p}rw WHERE e < len(cum))),
{p}chunks AS (
  SELECT article_id, title, CAST(k AS BIGINT) AS idx,
         trim(array_to_string(pcs[s:e], ''), {WS}) AS chunk_text
  FROM {p}rw)"""


def encode_cte(name: str, source: str, key_cols: str, text_col: str,
               dim: int = EMBEDDING_DIMENSION) -> str:
    """M1 hashed bag of words as sparse rows (keys..., b, w float)."""
    return f"""
{name}_tok AS (SELECT {key_cols}, unnest(regexp_extract_all(lower({text_col}), '{TOK}')) AS t FROM {source}),
{name}_cnt AS (SELECT {key_cols}, ('0x' || substr(md5(t), 1, {HASH_HEX_DIGITS}))::BIGINT % {dim} AS b,
                      count(*) AS c FROM {name}_tok GROUP BY ALL),
{name}_nrm AS (SELECT {key_cols}, sqrt(sum(c * c)) AS n FROM {name}_cnt GROUP BY ALL),
{name} AS (SELECT {key_cols}, b, CAST(c / n AS FLOAT) AS w FROM {name}_cnt JOIN {name}_nrm USING ({key_cols}))"""


def shortlist_cte(k: int = RETRIEVAL_CANDIDATES) -> str:
    """W1 over chunks for the benchmark queries: exact cosine, rank <= k."""
    return f"""
qry AS (SELECT item_id AS query_id, trim(text, {WS}) AS query FROM benchmark
        WHERE text IS NOT NULL AND trim(text, {WS}) <> ''),
{encode_cte('qvec', 'qry', 'query_id', 'query')},
{encode_cte('cvec', 'chunks', 'article_id, idx', 'chunk_text')},
qn AS (SELECT query_id, sqrt(sum(CAST(w AS DOUBLE) * CAST(w AS DOUBLE))) AS n FROM qvec GROUP BY ALL),
cn AS (SELECT article_id, idx, sqrt(sum(CAST(w AS DOUBLE) * CAST(w AS DOUBLE))) AS n FROM cvec GROUP BY ALL),
dots AS (SELECT q.query_id, c.article_id, c.idx, sum(CAST(q.w AS DOUBLE) * CAST(c.w AS DOUBLE)) AS dot
         FROM qvec q JOIN cvec c USING (b) GROUP BY ALL),
sims AS (SELECT qn.query_id, cn.article_id, cn.idx AS position,
                round(coalesce(d.dot, 0.0) / (qn.n * cn.n), 6) AS score
         FROM qn CROSS JOIN cn LEFT JOIN dots d
           ON d.query_id = qn.query_id AND d.article_id = cn.article_id AND d.idx = cn.idx),
sl AS (SELECT * FROM (
         SELECT query_id, article_id, position, score,
                row_number() OVER (PARTITION BY query_id ORDER BY score DESC, article_id, position) AS rank
         FROM sims) WHERE rank <= {k})"""


def rebuild_cte(source: str, key: str = "article_id", pos: str = "idx", text: str = "chunk_text",
                overlap: int = CHUNK_OVERLAP) -> str:
    """A5: fold ordered chunks, keeping each chunk's span. -> rtext(key, text), rspan(key, position, start, end)."""
    ov = (f"coalesce(list_filter(range(least({overlap}, length(rb.acc), length(c.t)), 0, -1), "
          f"lambda n: right(rb.acc, n) = left(c.t, n))[1], 0)")
    return f"""
rch AS (SELECT {key} AS key, {pos} AS position, {text} AS t,
               row_number() OVER (PARTITION BY {key} ORDER BY {pos}) AS k FROM {source}),
rb AS (
  SELECT key, k, t AS acc, position, 0::BIGINT AS start, length(t)::BIGINT AS "end" FROM rch WHERE k = 1
  UNION ALL
  SELECT key, k, CASE WHEN ov > 0 THEN acc || substr(t, ov + 1) ELSE acc || ' ' || t END,
         position,
         CASE WHEN ov > 0 THEN length(acc) - ov ELSE length(acc) + 1 END,
         CASE WHEN ov > 0 THEN length(acc) - ov ELSE length(acc) + 1 END + length(t)
  FROM (SELECT rb.key, c.k, rb.acc, c.t, c.position, {ov} AS ov
        FROM rb JOIN rch c ON c.key = rb.key AND c.k = rb.k + 1)),
rtext AS (SELECT key AS {key}, arg_max(acc, k) AS text FROM rb GROUP BY key),
rspan AS (SELECT key AS {key}, position, start, "end" FROM rb)"""


def sentences_cte(source: str = "rtext", key: str = "article_id") -> str:
    """G3 -> sents(key, sentence_index, start, end, piece, raw_start)."""
    return f"""
pcs AS (SELECT {key}, unnest(regexp_extract_all(text, '{SENT}')) AS piece,
               generate_subscripts(regexp_extract_all(text, '{SENT}'), 1) AS pi FROM {source}),
pcs2 AS (SELECT {key}, pi, piece,
                CAST(coalesce(sum(length(piece)) OVER (PARTITION BY {key} ORDER BY pi
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS raw_start
         FROM pcs),
sents AS (
  SELECT {key}, piece, raw_start,
         raw_start + length(piece) - length(regexp_replace(piece, '^\\s+', '')) AS start,
         raw_start + length(regexp_replace(piece, '\\s+\\z', '')) AS "end",
         CAST(row_number() OVER (PARTITION BY {key} ORDER BY pi) - 1 AS BIGINT) AS sentence_index
  FROM pcs2 WHERE regexp_replace(piece, '^\\s+|\\s+\\z', '') <> '')"""


def windows_cte(key: str = "article_id") -> str:
    """G4 -> win(key, window_index, window_count, start, end, text, first_sentence, n_sentences)."""
    return f"""
sw AS (SELECT *, lead("end", 1) OVER w AS e1, lead("end", 2) OVER w AS e2,
              lead(piece, 1) OVER w AS p1, lead(piece, 2) OVER w AS p2,
              CAST(count(*) OVER (PARTITION BY {key}) AS BIGINT) AS n
       FROM sents WINDOW w AS (PARTITION BY {key} ORDER BY sentence_index)),
sw2 AS (SELECT *, unnest(range(1, least(3, n - sentence_index) + 1)) AS size FROM sw),
win AS (
  SELECT {key},
         3 * sentence_index + size - 1 - CASE WHEN sentence_index = n - 1 AND n >= 2 THEN 1 ELSE 0 END AS window_index,
         CASE WHEN n >= 2 THEN 3 * n - 3 ELSE n END AS window_count,
         sentence_index AS first_sentence, size AS n_sentences, start,
         CASE size WHEN 1 THEN "end" WHEN 2 THEN e1 ELSE e2 END AS "end",
         substr(CASE size WHEN 1 THEN piece WHEN 2 THEN piece || p1 ELSE piece || p1 || p2 END,
                start - raw_start + 1,
                (CASE size WHEN 1 THEN "end" WHEN 2 THEN e1 ELSE e2 END) - start) AS text
  FROM sw2)"""


# M4 default: the share of the query's distinct tokens that the window holds, by its length
OVERLAP_SCORE = f"""round(CASE WHEN len(regexp_extract_all(lower(w.text), '{TOK}')) = 0
                      OR len(list_distinct(regexp_extract_all(lower(q.query), '{TOK}'))) = 0 THEN 0.0
                    ELSE CAST(len(list_intersect(list_distinct(regexp_extract_all(lower(q.query), '{TOK}')),
                                                 list_distinct(regexp_extract_all(lower(w.text), '{TOK}')))) AS DOUBLE)
                         / len(list_distinct(regexp_extract_all(lower(q.query), '{TOK}')))
                         / sqrt(CAST(len(regexp_extract_all(lower(w.text), '{TOK}')) AS DOUBLE)) END, 6)"""


def bm25_cte(k1: float, b: float, proximity: float) -> str:
    """M4, BM25 with proximity over the capped windows -> bm(query_id, article_id, window_index, score)."""
    key = "query_id, article_id, window_index"
    return f"""
ctk AS (SELECT article_id, idx, regexp_extract_all(lower(chunk_text), '{TOK}') AS t FROM chunks),
cst AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM ctk),
cdf AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT article_id, idx, unnest(t) AS term FROM ctk) GROUP BY term),
qtm AS (SELECT DISTINCT query_id, unnest(regexp_extract_all(lower(query), '{TOK}')) AS term FROM qry),
qid AS (SELECT query_id, term, ln(1 + (n - coalesce(df, 0) + 0.5) / (coalesce(df, 0) + 0.5)) AS idf
        FROM qtm LEFT JOIN cdf USING (term) CROSS JOIN cst),
wtk AS (SELECT c.query_id, c.article_id, c.window_index, regexp_extract_all(lower(w.text), '{TOK}') AS t
        FROM capped c JOIN win w USING (article_id, window_index)),
wex AS (SELECT {key}, len(t) AS l, unnest(t) AS term, generate_subscripts(t, 1) AS p FROM wtk),
occ AS (SELECT {key}, l, term, p, idf FROM wex JOIN qid USING (query_id, term)),
tfs AS (SELECT {key}, term, any_value(idf) AS idf, any_value(l) AS l, count(*) AS tf FROM occ GROUP BY {key}, term),
bms AS (SELECT {key}, count(*) AS m,
               sum(idf * tf * {k1 + 1} / (tf + {k1} * (1 - {b} + {b} * l / (SELECT mean FROM cst)))) AS s
        FROM tfs GROUP BY {key}),
lst AS (SELECT e.query_id, e.article_id, e.window_index, e.p, o.term, max(o.p) AS q FROM occ e JOIN occ o
          ON o.query_id = e.query_id AND o.article_id = e.article_id AND o.window_index = e.window_index AND o.p <= e.p
        GROUP BY e.query_id, e.article_id, e.window_index, e.p, o.term),
spn AS (SELECT {key}, min(width) AS span FROM (
          SELECT {key}, l.p - min(l.q) + 1 AS width FROM lst l JOIN bms USING ({key})
          GROUP BY {key}, l.p, bms.m HAVING count(*) = bms.m) GROUP BY {key}),
bm AS (SELECT {key}, round(coalesce(CASE WHEN m > 1 THEN s * (1 + {proximity} * m / span) ELSE s END, 0.0), 6) AS score
       FROM capped LEFT JOIN bms USING ({key}) LEFT JOIN spn USING ({key})),"""


def quote_cte(limit: int = DEFAULT_RESULT_LIMIT, max_windows: int = RERANK_MAX_WINDOWS, scorer: str = "",
              score: str = OVERLAP_SCORE) -> str:
    """E1 after the shortlist: -> hits. ``scorer`` holds the CTEs of another scorer, which
    end in bm, and ``score`` its column."""
    return f"""
ar AS (SELECT query_id, article_id,
              row_number() OVER (PARTITION BY query_id ORDER BY max(score) DESC, min(rank)) AS article_rank
       FROM sl GROUP BY query_id, article_id),
cart AS (SELECT * FROM chunks WHERE article_id IN (SELECT article_id FROM sl)),
{rebuild_cte('cart')},
{sentences_cte()},
{windows_cte()},
cspan AS (SELECT sl.query_id, s.article_id, s.start, s."end" FROM sl JOIN rspan s
            ON s.article_id = sl.article_id AND s.position = sl.position),
sel AS (SELECT DISTINCT c.query_id, w.article_id, w.window_index FROM win w JOIN cspan c
          ON c.article_id = w.article_id
         WHERE least(w."end", c."end") - greatest(w.start, c.start) > 0),
capped AS (SELECT * FROM (
             SELECT sel.*, ar.article_rank,
                    row_number() OVER (PARTITION BY sel.query_id ORDER BY ar.article_rank, sel.window_index) AS wr
             FROM sel JOIN ar USING (query_id, article_id)) WHERE wr <= {max_windows}),
home AS (
  SELECT article_id, window_index, position AS chunk_position FROM (
    SELECT w.article_id, w.window_index, s.position,
           row_number() OVER (PARTITION BY w.article_id, w.window_index
                              ORDER BY least(w."end", s."end") - greatest(w.start, s.start) DESC, s.position) AS r
    FROM (SELECT DISTINCT article_id, window_index FROM capped) c
    JOIN win w USING (article_id, window_index)
    JOIN rspan s ON s.article_id = w.article_id
    WHERE least(w."end", s."end") - greatest(w.start, s.start) > 0) WHERE r = 1),
firstpos AS (SELECT article_id, min(position) AS fp FROM rspan GROUP BY article_id),{scorer}
scored AS (
  SELECT c.query_id, c.article_id, c.article_rank, c.window_index, w.window_count,
         coalesce(h.chunk_position, f.fp) AS chunk_position, w.start, w."end", w.text,
         {score} AS score
  FROM capped c JOIN win w USING (article_id, window_index)
  LEFT JOIN home h USING (article_id, window_index)
  JOIN firstpos f USING (article_id)
  JOIN qry q USING (query_id){' JOIN bm USING (query_id, article_id, window_index)' if scorer else ''}),
gr AS (SELECT *, row_number() OVER (PARTITION BY query_id, article_id ORDER BY score DESC, window_index) AS g
       FROM scored),
greedy AS (
  SELECT query_id, article_id, g, [struct_pack(s := start, e := "end", i := window_index)] AS kept FROM gr WHERE g = 1
  UNION ALL
  SELECT x.query_id, x.article_id, x.g,
         CASE WHEN len(list_filter(y.kept, lambda k: k.s < x."end" AND x.start < k.e)) > 0 THEN y.kept
              ELSE list_append(y.kept, struct_pack(s := x.start, e := x."end", i := x.window_index)) END
  FROM greedy y JOIN gr x ON x.query_id = y.query_id AND x.article_id = y.article_id AND x.g = y.g + 1),
keptl AS (SELECT query_id, article_id, arg_max(kept, g) AS kept FROM greedy GROUP BY query_id, article_id),
keptw AS (SELECT query_id, article_id, kk.i AS window_index
          FROM (SELECT query_id, article_id, unnest(kept) AS kk FROM keptl)),
hits AS (SELECT * FROM (
           SELECT s.*, row_number() OVER (PARTITION BY s.query_id ORDER BY s.score DESC, s.article_rank, s.window_index) AS hit_rank
           FROM scored s JOIN keptw USING (query_id, article_id, window_index)) WHERE hit_rank <= {limit})"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(c.strip("\n") for c in ctes)
