"""Window scoring by BM25 with proximity (M4).

Corpus statistics are written once: the document frequency of every word over
the units of retrieval (chunks), their number and mean length. A query's
words meet them in an equi-join; the weights of a query, at most as many as it
has words, then travel with its windows. Everything about a window is an
expression over its own words: occurrences, BM25, and a fold that finds the
smallest span holding all words that the window shares with the query.

    idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5))
    bm25   = sum of idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))
    score  = bm25 * (1 + proximity * m / span), for m > 1 shared words
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.tokens import tokens
from lectern.operators.rerank import SCORE_DIGITS
from lectern.session import written

K1 = 1.2            # how soon more occurrences of a word stop counting
B = 0.75            # how much a window's length counts
PROXIMITY = 1.0     # how much it counts that the shared words stand together


@dataclass(frozen=True)
class Statistics:
    """(term, df) over the units, their number and mean length in words."""
    terms: DataFrame
    n_units: int
    mean_tokens: float


def corpus_statistics(units: DataFrame, text: str = "text") -> Statistics:
    """Counted in two passes; a null text is a unit without words."""
    cut = units.select(tokens(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    n, mean = cut.agg(F.count(F.lit(1)), F.avg(F.size("_t"))).first()
    terms = (cut.select(F.explode_outer(F.array_distinct("_t")).alias("term")).where(F.col("term").isNotNull())
             .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    return Statistics(written(terms, "term_statistics"), n, mean or 0.0)


def query_weights(queries: DataFrame, statistics: Statistics) -> DataFrame:
    """queries (query_id, query) -> (query_id, _q, _idf): distinct words and their weights,
    two arrays in one order. A word that no unit holds weighs most."""
    words = (queries.select("query_id", F.explode_outer(F.array_distinct(tokens(F.col("query")))).alias("term"))
             .where(F.col("term").isNotNull()))
    df = F.coalesce(F.col("df"), F.lit(0))
    idf = F.log(1 + (F.lit(float(statistics.n_units)) - df + 0.5) / (df + 0.5))
    each = words.join(statistics.terms, "term", "left").select("query_id", F.struct("term", idf.alias("idf")).alias("_s"))
    return (each.groupBy("query_id").agg(F.array_sort(F.collect_list("_s")).alias("_s"))
            .select("query_id", F.col("_s.term").alias("_q"), F.col("_s.idf").alias("_idf")))


def smallest_span(hits: F.Column, kinds: F.Column) -> F.Column:
    """Fewest neighbouring words that hold every kind, from ``hits`` (k, p) in order of
    the place p: the fold keeps each kind's last place."""
    def step(s, h):
        last = F.transform(s["last"], lambda v, j: F.when(F.element_at(kinds, j + 1) == h["k"], h["p"]).otherwise(v))
        least = F.array_min(last)
        return F.struct(last.alias("last"), F.least(s["best"], F.when(least >= 0, h["p"] - least + 1)
                                                    .otherwise(s["best"])).alias("best"))
    start = F.struct(F.array_repeat(F.lit(-1), F.size(kinds)).alias("last"), F.lit((1 << 31) - 1).alias("best"))
    return F.aggregate(hits, start, step, lambda s: s["best"])


def score_bm25(pairs: DataFrame, queries: DataFrame, statistics: Statistics, k1: float = K1, b: float = B,
               proximity: float = PROXIMITY) -> DataFrame:
    """pairs (..., query_id, text) -> + score. A window that shares no word with the
    query, and a null text, score 0."""
    made = pairs.join(query_weights(queries, statistics), "query_id", "left").withColumn(
        "_w", tokens(F.coalesce(F.col("text"), F.lit(""))))
    # each of these columns is used several times below, so it is made in a step of its own
    made = made.withColumn("_h", F.filter(
        F.transform("_w", lambda t, i: F.struct(F.array_position("_q", t).alias("k"), i.alias("p"))), lambda h: h["k"] > 0))
    mean = statistics.mean_tokens or 1.0            # units without words say nothing of a usual length
    made = made.withColumn("_k", F.array_distinct(F.transform("_h", lambda h: h["k"]))).withColumn(
        "_n", k1 * (1 - b + b * F.size("_w") / F.lit(mean)))

    def weight(k):
        tf = F.size(F.filter("_h", lambda h: h["k"] == k))
        return F.element_at("_idf", k.cast("int")) * tf * (k1 + 1) / (tf + F.col("_n"))
    bm25 = F.aggregate("_k", F.lit(0.0), lambda s, k: s + F.coalesce(weight(k), F.lit(0.0)))
    made = made.withColumn("_s", bm25).withColumn("_span", smallest_span(F.col("_h"), F.col("_k")))
    near = F.when(F.size("_k") > 1, 1 + proximity * F.size("_k") / F.col("_span")).otherwise(F.lit(1.0))
    return made.withColumn("score", F.round(F.coalesce(F.col("_s") * near, F.lit(0.0)), SCORE_DIGITS)).drop(
        "_q", "_idf", "_w", "_h", "_k", "_n", "_s", "_span")
