"""Window scoring (M4), greedy overlap removal (W4) and the final top-N (L4).

The default scorer is plain SQL: the share of the query's distinct tokens
found in the window, divided by the square root of the window's token
count, rounded to 6 digits. A user scorer (a cross-encoder, say) plugs in
through an Arrow UDF over (query, window) pairs.

Greedy removal keeps a window unless a better window of the same article
that was kept overlaps it. Keeping depends only on better rows of the same
article, so it runs per (query, article) on at most ``max_windows`` rows, as
a JVM fold over the sorted group, and a window on query_id then takes the
top N.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.config import DEFAULT_RESULT_LIMIT
from lectern.functions.models import model_key, worker_model
from lectern.functions.tokens import tokens

SCORE_DIGITS = 6


def lexical_score(qd: F.Column, wt: F.Column) -> F.Column:
    """From the query's distinct tokens and the window's tokens, columns that are
    made beforehand: inside the branches below each would be cut again."""
    hits = F.size(F.array_intersect(qd, F.array_distinct(wt)))
    raw = F.when((F.size(wt) == 0) | (F.size(qd) == 0), F.lit(0.0)).otherwise(
        hits / F.size(qd) / F.sqrt(F.size(wt).cast("double")))
    return F.round(raw, SCORE_DIGITS)


def _scorer_udf(factory, batch_size: int):
    key = model_key(factory)

    @F.pandas_udf(T.DoubleType())
    def score_pairs(queries: pd.Series, texts: pd.Series) -> pd.Series:
        model = worker_model(key, factory)
        out = []
        pairs = list(zip(queries.astype(str), texts.astype(str)))
        for i in range(0, len(pairs), batch_size):
            out.extend(float(s) for s in model.predict(pairs[i:i + batch_size]))
        if len(out) != len(pairs) or not np.isfinite(out).all():
            raise ValueError("scorer returned a wrong count or non-finite scores")
        return pd.Series(out).round(SCORE_DIGITS)
    return score_pairs


def score_windows(pairs: DataFrame, scorer_factory=None, batch_size: int = 16) -> DataFrame:
    """pairs: (..., query, text) -> + score."""
    if scorer_factory is None:
        cut = pairs.withColumn("_qd", F.array_distinct(tokens(F.col("query")))).withColumn("_wt", tokens(F.col("text")))
        return cut.withColumn("score", lexical_score(F.col("_qd"), F.col("_wt"))).drop("_qd", "_wt")
    return pairs.withColumn("score", _scorer_udf(scorer_factory, batch_size)(F.col("query"), F.col("text")))


def greedy_non_overlapping(scored: DataFrame, group: tuple[str, ...] = ("query_id", "article_id"),
                           order_tail: tuple[str, ...] = ("window_index",)) -> DataFrame:
    """Per group, by score desc (then ``order_tail``), keep a row unless it
    overlaps (> 0 chars) a row kept before it. Rows need start and end."""
    cols = [c for c in scored.columns if c not in group]
    key = F.struct(
        (-F.col("score")).alias("_neg"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_tail)],
        F.struct(*[F.col(c) for c in cols]).alias("row"))
    g = scored.groupBy(*group).agg(F.array_sort(F.collect_list(key)).alias("_rows"))
    empty = F.filter(F.col("_rows.row"), lambda r: F.lit(False))
    kept = F.aggregate(
        F.col("_rows.row"), empty,
        lambda acc, r: F.when(
            F.exists(acc, lambda k: (k["start"] < r["end"]) & (r["start"] < k["end"])), acc
        ).otherwise(F.concat(acc, F.array(r))))
    return g.select(*group, F.explode(kept).alias("_k")).select(*group, "_k.*")


def top_hits(kept: DataFrame, limit: int = DEFAULT_RESULT_LIMIT) -> DataFrame:
    """L4: best ``limit`` rows per query by score, ties in (article rank, window index)."""
    if limit <= 0:
        raise ValueError(f"{limit} hits a query cannot be returned")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "article_rank", "window_index")
    return kept.withColumn("hit_rank", F.row_number().over(w)).where(F.col("hit_rank") <= limit)
