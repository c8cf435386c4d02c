"""Full-text postings and search.

Postings are (term, article_id, tf, positions): word tokens of the
lower-cased text, positions counted over all tokens (stop words hold their
place but get no postings). Search joins the query terms with the postings
on term (an equi-join, so only matching posting lists are read) and ranks
by sum of tf x ln(N / df). ``mode='and'`` keeps articles holding every
query term, ``'or'`` any of them. Stemming is out of scope.

``phrase_search`` intersects shifted positions. ``search_blocks`` gives the rows
of ``search`` from postings in blocks of neighbouring articles: a block's
largest term frequencies bound its scores, and blocks whose bound is below
the k-th score found so far are never joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.tokens import tokens
from lectern.operators.topics import STOP_WORDS
from lectern.session import discard, written


def postings(docs: DataFrame, key: str = "article_id", text: str = "text",
             stop_words=STOP_WORDS) -> DataFrame:
    toks = docs.select(key, tokens(F.col(text)).alias("_t"))
    ex = toks.select(key, F.posexplode_outer("_t").alias("_p", "term")) \
        .where(F.col("term").isNotNull() & ~F.col("term").isin(list(stop_words)))
    return ex.groupBy("term", key).agg(
        F.count(F.lit(1)).alias("tf"),
        F.array_sort(F.collect_list((F.col("_p") + 1).cast("int"))).alias("positions"))


def search(queries: DataFrame, post: DataFrame, n_docs: int | None = None, mode: str = "or",
           top: int = 10, key: str = "article_id", stop_words=STOP_WORDS) -> DataFrame:
    """queries (query_id, query) -> (query_id, key, score, matched, rank), best ``top`` per query."""
    if mode not in ("and", "or"):
        raise ValueError("mode must be 'and' or 'or'")
    q = queries.select("query_id", F.array_distinct(F.filter(tokens(F.col("query")),
                                                            lambda t: ~t.isin(list(stop_words)))).alias("_qt"))
    qt = q.select("query_id", F.size("_qt").alias("_nq"), F.explode_outer("_qt").alias("term")) \
        .where(F.col("term").isNotNull())
    if n_docs is None:
        n_docs = post.select(key).distinct().count()
    # document frequencies of the asked terms alone
    df = (post.join(qt.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.count(F.lit(1)).alias("_df")))
    idf = F.log(F.lit(float(n_docs)) / F.col("_df"))
    hits = qt.join(post, "term").join(df, "term").withColumn("_w", F.col("tf") * idf)
    agg = hits.groupBy("query_id", key).agg(F.round(F.sum("_w"), 6).alias("score"),
                                            F.count(F.lit(1)).alias("matched"), F.first("_nq").alias("_nq"))
    if mode == "and":
        agg = agg.where(F.col("matched") == F.col("_nq"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return (agg.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("query_id", key, "score", "matched", "rank"))


# ------------------------------------------------------------------ phrases


def phrase_search(queries: DataFrame, post: DataFrame, top: int = 10, key: str = "article_id",
                  stop_words=STOP_WORDS) -> DataFrame:
    """queries (query_id, query) -> (query_id, key, occurrences, first_position, rank): articles that
    hold the query's words in a row.

    A stop word holds its place and matches any word. Ranked by occurrences,
    ties by key. Only articles with the query's rarest word are looked at; the
    other words are joined on word and article together, so a frequent word is
    spread over its articles. A query without indexed words finds nothing."""
    stop = list(stop_words)
    words = queries.select("query_id", F.posexplode_outer(tokens(F.col("query"))).alias("off", "term"))
    words = words.where(F.col("term").isNotNull() & ~F.col("term").isin(stop))
    df = (post.join(words.select("term").distinct(), "term", "left_semi")
          .groupBy("term").agg(F.count(F.lit(1)).alias("_df")))
    # a word that is not indexed has no frequency: it comes first and leaves the query without articles
    rarest = (words.join(df, "term", "left").groupBy("query_id").agg(
        F.min(F.struct(F.coalesce("_df", F.lit(0)).alias("df"), "term")).alias("_r"), F.count(F.lit(1)).alias("_n"))
        .select("query_id", "_n", F.col("_r.term").alias("term")))
    near = rarest.join(post.select("term", key), "term").select("query_id", "_n", key)
    starts = (words.join(near, "query_id").join(post.select("term", key, "positions"), ["term", key])
              .select("query_id", key, "_n", F.transform("positions", lambda p: p - F.col("off")).alias("_s")))
    # as many rows a group as the query has words
    both = starts.groupBy("query_id", key).agg(F.first("_n").alias("_n"), F.collect_list("_s").alias("_s")).where(F.size("_s") == F.col("_n"))
    found = both.withColumn("_s", F.filter(F.aggregate(F.slice("_s", 2, 1 << 30), F.col("_s")[0], lambda a, b: F.array_intersect(a, b)),
                                           lambda p: p >= 1))
    w = Window.partitionBy("query_id").orderBy(F.desc("occurrences"), key)
    return (found.where(F.size("_s") > 0)
            .select("query_id", key, F.size("_s").cast("long").alias("occurrences"), F.array_min("_s").alias("first_position"))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top))


# ------------------------------------------------------------------ blocks

BLOCK = 128                 # neighbouring keys in a block
FIRST_BLOCKS = 4            # blocks of a query that are scored before any bound is known


def block_postings(post: DataFrame, key: str = "article_id", size: int = BLOCK) -> DataFrame:
    """(term, block, most, rows): the postings of a term in a block of ``size`` neighbouring
    keys, and its largest frequency there."""
    return (post.groupBy("term", F.floor(F.col(key) / size).cast("long").alias("block"))
            .agg(F.max("tf").alias("most"), F.collect_list(F.struct(F.col(key).alias("k"), "tf")).alias("rows")))


def _score_blocks(asked: DataFrame, blocks: DataFrame, qt: DataFrame, key: str) -> DataFrame:
    """(query_id, key, score, matched) over the (query, block) pairs ``asked``."""
    rows = (asked.join(qt, "query_id").join(blocks.select("term", "block", "rows"), ["term", "block"])
            .select("query_id", "_idf", F.explode("rows").alias("r")))
    return rows.groupBy("query_id", F.col("r.k").alias(key)).agg(
        F.round(F.sum(F.col("r.tf") * F.col("_idf")), 6).alias("score"), F.count(F.lit(1)).alias("matched"))


def search_blocks(queries: DataFrame, blocks: DataFrame, n_docs: int, top: int = 10, key: str = "article_id",
                  stop_words=STOP_WORDS) -> DataFrame:
    """The rows of ``search`` in mode 'or', from ``block_postings``.

    A block can score no more than the sum of its largest frequencies times idf.
    The few blocks of the highest bounds are scored first; their k-th score is a
    floor, and of the other blocks only those whose bound reaches it are scored."""
    q = queries.select("query_id", F.explode_outer(F.array_distinct(F.filter(
        tokens(F.col("query")), lambda t: ~t.isin(list(stop_words))))).alias("term")).where(F.col("term").isNotNull())
    df = (blocks.join(q.select("term").distinct(), "term", "left_semi").groupBy("term")
          .agg(F.sum(F.size("rows")).alias("_df")))
    scratch: list[str] = []
    qt = written(q.join(df, "term").select("query_id", "term", F.log(F.lit(float(n_docs)) / F.col("_df")).alias("_idf")),
                 "query_terms", scratch)
    bound = written(qt.join(blocks.select("term", "block", "most"), "term").groupBy("query_id", "block").agg(
        F.sum(F.col("most") * F.col("_idf")).alias("bound")), "block_bounds", scratch)
    best = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    turn = written(bound.withColumn("_t", F.row_number().over(best)), "block_turns", scratch)
    first = written(_score_blocks(turn.where(F.col("_t") <= FIRST_BLOCKS).select("query_id", "block"), blocks, qt, key),
                    "first_scores", scratch)
    ranked = first.withColumn("_r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), key)))
    floor = ranked.where(F.col("_r") == top).select("query_id", F.col("score").alias("floor"))
    # scores are rounded, bounds are not
    rest = (turn.where(F.col("_t") > FIRST_BLOCKS).join(floor, "query_id", "left")
            .where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor") - 1e-5)).select("query_id", "block"))
    every = first.unionByName(_score_blocks(rest, blocks, qt, key))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    out = written(every.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
                  .select("query_id", key, "score", "matched", "rank"), "block_hits")
    discard(out.sparkSession, scratch)
    return out
