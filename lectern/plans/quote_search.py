"""Quote search over a table of queries.

encode queries -> cosine shortlist of chunks (top 50) -> rank candidate
articles -> fetch all chunks of those articles -> rebuild each article once
-> sentences -> 1..3-sentence windows -> windows touching a candidate chunk
-> cap 200 per query -> home chunk -> score -> greedy overlap removal ->
top N per query, with article fields.

Every step is a DataFrame operation. Articles are rebuilt once no matter
how many queries hit them; per-query work is bounded by the shortlist and
the window cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.config import DEFAULT_RESULT_LIMIT, MAX_QUERY_CHARS, MAX_QUOTE_LIMIT, RERANK_MAX_WINDOWS, RETRIEVAL_CANDIDATES
from lectern.operators.bm25 import Statistics, score_bm25
from lectern.operators.chunk import reconstruct_articles
from lectern.operators.encode import encode_queries
from lectern.operators.rerank import greedy_non_overlapping, score_windows, top_hits
from lectern.operators.shortlist import shortlist
from lectern.operators.windows import (cap_windows, explode_spans, sentence_windows, sentences,
                                       window_home_chunk, window_texts, windows_in_candidates)
from lectern.session import written


def validate_request(limit: int, k: int, max_windows: int) -> None:
    if not 1 <= limit <= MAX_QUOTE_LIMIT:
        raise ValueError(f"{limit} hits were asked for, 1 to {MAX_QUOTE_LIMIT} can be")
    if k <= 0:
        raise ValueError(f"a shortlist of {k} chunks is empty")
    if max_windows < 0:
        raise ValueError(f"{max_windows} windows cannot be scored")


def require_queries(queries: DataFrame) -> None:
    """A query has 1 to MAX_QUERY_CHARS characters and is not blank."""
    text = F.regexp_replace("query", r"^\s+|\s+\z", "")
    bad = queries.where(F.col("query").isNull() | (text == "") | (F.length("query") > MAX_QUERY_CHARS)).limit(1).collect()
    if bad:
        raise ValueError(f"query {bad[0]['query_id']} is blank or longer than {MAX_QUERY_CHARS} characters")


def filter_chunks(chunks: DataFrame, articles: DataFrame, topic_id: int | None = None,
                  tag: str | None = None, article_tags: DataFrame | None = None) -> DataFrame:
    """Optional topic / tag filters, applied as semi joins before the shortlist."""
    if topic_id is not None:
        ids = articles.where(F.col("topic_id") == topic_id).select(F.col("id").alias("article_id"))
        chunks = chunks.join(ids, "article_id", "left_semi")
    if tag is not None:
        if article_tags is None:
            raise ValueError("tag filter needs the article_tags table")
        ids = article_tags.where(F.col("name") == tag).select("article_id")
        chunks = chunks.join(ids, "article_id", "left_semi")
    return chunks


def article_ranks(cands: DataFrame) -> DataFrame:
    """Per query, articles by best score desc, ties by first appearance."""
    per = cands.groupBy("query_id", "article_id").agg(
        F.max("score").alias("best"), F.min("rank").alias("first"))
    w = Window.partitionBy("query_id").orderBy(F.desc("best"), "first")
    return per.select("query_id", "article_id", F.row_number().over(w).alias("article_rank"))


def candidate_chunks(chunks: DataFrame, cands: DataFrame) -> DataFrame:
    """Every chunk of every candidate article (semi join on the id set)."""
    ids = cands.select("article_id").distinct()
    return chunks.join(ids, "article_id", "left_semi")


def quote_search(queries: DataFrame, chunk_vectors: DataFrame, articles: DataFrame,
                 limit: int = DEFAULT_RESULT_LIMIT, k: int = RETRIEVAL_CANDIDATES,
                 max_windows: int = RERANK_MAX_WINDOWS, encoder_factory=None,
                 scorer_factory=None, stages: dict | None = None, materialize: bool = True,
                 topic_id: int | None = None, tag: str | None = None,
                 article_tags: DataFrame | None = None, statistics: Statistics | None = None) -> DataFrame:
    """queries: (query_id, query); chunk_vectors: (article_id, position, text,
    embedding); articles: serving articles (id, title, url, author,
    published_at, topic_id). With ``topic_id`` or ``tag`` only chunks of such
    articles are searched; a tag needs article_tags (article_id, name). With
    ``statistics`` of the chunks, windows are scored by BM25 with proximity."""
    if statistics is not None and scorer_factory is not None:
        raise ValueError("windows are scored by BM25 or by a scorer of one's own, not by both")
    validate_request(limit, k, max_windows)
    require_queries(queries)
    qv = encode_queries(queries, encoder_factory)
    cands = shortlist(qv, filter_chunks(chunk_vectors, articles, topic_id, tag, article_tags), k=k)
    if materialize:
        cands = written(cands, "candidates")  # queries x k rows, read by four branches
    ranks = article_ranks(cands)

    fetched = candidate_chunks(chunk_vectors.select("article_id", "position", "text"), cands)
    rebuilt = reconstruct_articles(fetched)
    if materialize:
        # rebuilt articles and their windows feed several branches (selection,
        # the cap join, home-chunk mapping, texts): written once, columns prunable
        rebuilt = written(rebuilt, "rebuilt")
    # windows are chosen by their offsets; only those that are scored get their text
    wins = sentence_windows(sentences(rebuilt)).drop("text")
    if materialize:
        wins = written(wins, "windows")
    spans = explode_spans(rebuilt)

    cand_spans = cands.select("query_id", "article_id", "position").join(
        spans, ["article_id", "position"])
    selected = windows_in_candidates(wins, cand_spans)
    capped = cap_windows(selected, ranks, max_windows)
    capped = capped.join(wins, ["article_id", "window_index"])
    if materialize:
        capped = written(capped, "capped")      # at most max_windows rows a query, read by two branches
    home = window_home_chunk(capped.select("article_id", "window_index", "start", "end"), spans)
    capped = capped.join(home, ["article_id", "window_index"])
    capped = window_texts(capped, rebuilt)
    asked = queries.select("query_id", "query")
    if statistics is not None:
        scored = score_bm25(capped, asked, statistics)
    else:
        scored = score_windows(capped.join(asked, "query_id"), scorer_factory).drop("query")
    kept = greedy_non_overlapping(
        scored.select("query_id", "article_id", "article_rank", "window_index", "window_count",
                      "chunk_position", "start", "end", "text", "score"))
    hits = top_hits(kept, limit)
    meta = articles.select(F.col("id").alias("article_id"), F.col("title").alias("article_title"),
                           F.col("url").alias("article_url"), "author", "published_at")
    out = hits.join(meta, "article_id", "left").select(
        "query_id", "hit_rank", "chunk_position", "window_index", "window_count", "text", "score",
        "article_id", "article_title", "article_url", "author", "published_at")
    if stages is not None:
        stages.update(candidates=cands, ranks=ranks, fetched=fetched, rebuilt=rebuilt, windows=wins,
                      selected=selected, capped=capped, scored=scored, home=home)
    return out
