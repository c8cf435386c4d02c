"""Sentences, sentence windows and their mapping onto chunks.

Sentences come from one regular expression that partitions a text into
consecutive pieces; offsets are running sums of piece lengths (never regex
positions, which are UTF-16 in the JVM). The running sum is a window over
article_id, which reuses the article_id partitioning left by the
reconstruction step, so it adds no shuffle.

Interval joins (window vs chunk span) are equi-joins on (article_id,
bucket) where a bucket is a fixed-width slice of character offsets; each
interval is listed under the buckets it touches, so the work is linear in
text length instead of all windows x all spans of an article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.config import CHUNK_SIZE, MAX_WINDOW_SENTENCES, RERANK_MAX_WINDOWS

# Fixed value: the sentence rule. A sentence runs lazily up to a run of
# terminators, optional closing quotes or brackets, then whitespace or the
# end of the text; the last one may end without a terminator.
SENTENCE_PATTERN = r"(?s).+?(?:[.!?…。！？]+[\"'”’»)\]]*(?:\s+|\z)|\z)"

BUCKET_WIDTH = CHUNK_SIZE


def _lead_ws(c: Column) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, r"^\s+", ""))


def _trail_ws(c: Column) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, r"\s+\z", ""))


def sentences(docs: DataFrame, key: str = "article_id", text: str = "text") -> DataFrame:
    """(key, text) -> (key, sentence_index, start, end, piece, raw_start).

    start/end are character offsets of the stripped sentence; ``piece`` is
    the raw matched text (with its trailing whitespace). Blank pieces are
    dropped and sentence_index counts from 0 over the rest.
    """
    pieces = docs.select(key, F.posexplode_outer(
        F.regexp_extract_all(F.col(text), F.lit(SENTENCE_PATTERN), 0)).alias("_pi", "piece")) \
        .where(F.col("_pi").isNotNull())
    # lengths are taken before the rows are shuffled, so that readers of offsets alone shuffle no text
    pieces = pieces.select(key, "_pi", "piece", F.length("piece").alias("_len"), _lead_ws(F.col("piece")).alias("_lead"),
                           _trail_ws(F.col("piece")).alias("_trail"))
    w = Window.partitionBy(key).orderBy("_pi")
    raw_start = F.coalesce(F.sum("_len").over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = pieces.withColumn("raw_start", raw_start.cast("int")).where(F.col("_lead") < F.col("_len"))
    s = s.select(
        key, "_pi", "piece", "raw_start",
        (F.col("raw_start") + F.col("_lead")).cast("int").alias("start"),
        (F.col("raw_start") + F.col("_len") - F.col("_trail")).cast("int").alias("end"),
    )
    return s.withColumn("sentence_index", (F.row_number().over(w) - 1).cast("int")).drop("_pi")


def sentence_windows(sents: DataFrame, key: str = "article_id",
                     max_sentences: int = MAX_WINDOW_SENTENCES) -> DataFrame:
    """Every run of 1..3 consecutive sentences.

    Ordered by first sentence then size; window_index is that order and
    window_count the number of windows of the article.
    """
    if max_sentences != 3:
        raise ValueError("window indexing is defined for runs of up to 3 sentences")
    w = Window.partitionBy(key).orderBy("sentence_index")
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    s = sents.select(
        key, "sentence_index", "start", "end", "piece", "raw_start",
        F.lead("end", 1).over(w).alias("_e1"), F.lead("end", 2).over(w).alias("_e2"),
        F.lead("piece", 1).over(w).alias("_p1"), F.lead("piece", 2).over(w).alias("_p2"),
        n.alias("_n"),
    )
    f = F.col("sentence_index")
    s = s.withColumn("size", F.explode(F.sequence(F.lit(1), F.least(F.lit(3), F.col("_n") - f))))
    size = F.col("size")
    w_end = F.when(size == 1, F.col("end")).when(size == 2, F.col("_e1")).otherwise(F.col("_e2"))
    raw = F.when(size == 1, F.col("piece")) \
        .when(size == 2, F.concat("piece", "_p1")) \
        .otherwise(F.concat("piece", "_p1", "_p2"))
    w_text = F.expr("substring(_raw, start - raw_start + 1, _wend - start)")
    last = (f == F.col("_n") - 1) & (F.col("_n") >= 2)
    return (s.withColumn("_wend", w_end).withColumn("_raw", raw)
            .select(
                key,
                (F.lit(3) * f + size - 1 - F.when(last, 1).otherwise(0)).cast("int").alias("window_index"),
                F.when(F.col("_n") >= 2, 3 * F.col("_n") - 3).otherwise(F.col("_n"))
                .cast("int").alias("window_count"),
                f.alias("first_sentence"),
                size.cast("int").alias("n_sentences"),
                F.col("start").cast("int").alias("start"),
                F.col("_wend").cast("int").alias("end"),
                w_text.alias("text"),
            ))


def char_overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """max(0, min(ends) - max(starts))."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def _buckets(start: Column, end: Column, width: int = BUCKET_WIDTH) -> Column:
    first = F.floor(start / width).cast("int")
    last = F.floor(F.greatest(end - 1, start) / width).cast("int")
    return F.explode(F.sequence(first, last))


def explode_spans(rebuilt: DataFrame, key: str = "article_id") -> DataFrame:
    """Reconstruction spans as rows (key, position, start, end)."""
    return rebuilt.select(key, F.explode("spans").alias("s")).select(
        key, F.col("s.position").alias("position"),
        F.col("s.start").alias("start"), F.col("s.end").alias("end"))


def windows_in_candidates(windows: DataFrame, cand_spans: DataFrame,
                          key: str = "article_id") -> DataFrame:
    """Windows overlapping (> 0 chars) a candidate chunk of the same query.

    windows: (key, window_index, start, end, ...); cand_spans: (query_id,
    key, start, end). Returns distinct (query_id, key, window_index).
    """
    wb = windows.select(key, "window_index", F.col("start").alias("ws"),
                        F.col("end").alias("we"), _buckets(F.col("start"), F.col("end")).alias("bucket"))
    cb = cand_spans.select("query_id", key, F.col("start").alias("cs"), F.col("end").alias("ce"),
                           _buckets(F.col("start"), F.col("end")).alias("bucket"))
    hit = wb.join(cb, [key, "bucket"]).where(char_overlap(F.col("ws"), F.col("we"), F.col("cs"), F.col("ce")) > 0)
    return hit.select("query_id", key, "window_index").repartition("query_id").dropDuplicates(
        ["query_id", key, "window_index"])


def cap_windows(selected: DataFrame, article_rank: DataFrame,
                max_windows: int = RERANK_MAX_WINDOWS, key: str = "article_id") -> DataFrame:
    """First ``max_windows`` per query in (article rank, window index) order."""
    if max_windows <= 0:
        return selected.limit(0)
    w = Window.partitionBy("query_id").orderBy("article_rank", "window_index")
    return (selected.join(article_rank, ["query_id", key])
            .withColumn("_wr", F.row_number().over(w))
            .where(F.col("_wr") <= max_windows).drop("_wr"))


def window_texts(windows: DataFrame, docs: DataFrame, key: str = "article_id", text: str = "text") -> DataFrame:
    """Windows (key, start, end, ...) with their text, cut from the documents'."""
    whole = docs.select(key, F.col(text).alias("_whole"))
    return windows.join(whole, key).withColumn("text", F.expr("substring(_whole, start + 1, end - start)")).drop("_whole")


def window_home_chunk(windows: DataFrame, spans: DataFrame, key: str = "article_id") -> DataFrame:
    """Chunk position overlapping each window the most, ties to the lower position.

    windows: (key, window_index, start, end); spans: (key, position, start, end).
    A window touching no chunk maps to the article's first chunk.
    """
    wb = windows.select(key, "window_index", F.col("start").alias("ws"), F.col("end").alias("we"),
                        _buckets(F.col("start"), F.col("end")).alias("bucket"))
    sb = spans.select(key, "position", F.col("start").alias("cs"), F.col("end").alias("ce"),
                      _buckets(F.col("start"), F.col("end")).alias("bucket"))
    ov = char_overlap(F.col("ws"), F.col("we"), F.col("cs"), F.col("ce"))
    pairs = wb.join(sb, [key, "bucket"]).withColumn("_ov", ov).where(F.col("_ov") > 0)
    best = pairs.groupBy(key, "window_index").agg(
        F.max_by("position", F.struct(F.col("_ov"), -F.col("position"))).alias("chunk_position"))
    first = spans.groupBy(key).agg(F.min("position").alias("_first"))
    return (windows.select(key, "window_index").distinct()
            .join(best, [key, "window_index"], "left")
            .join(first, key, "left")
            .select(key, "window_index",
                    F.coalesce("chunk_position", "_first").cast("int").alias("chunk_position")))
