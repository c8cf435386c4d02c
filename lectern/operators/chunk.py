"""Overlapping character chunks (G1) and article reconstruction (A5).

Chunking is one pass per document: an Arrow stage runs the packing rule on a
bounded slice of texts at a time and passes their chunks on as rows, so what a
worker holds does not grow with the input. No shuffle; the work spreads with the
input partitions.

Reconstruction needs every chunk of an article in order, so it groups by
article (one shuffle on article_id) and folds the ordered chunks with a small
Arrow UDF. A group is one article, never larger than the document it came
from.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.config import CHUNK_OVERLAP, CHUNK_SIZE
from lectern.functions.arrow import lean, row_slices

def _pack(text: str, at, size: int, overlap: int) -> list[str]:
    """Greedy packing of pieces into chunks of at most ``size`` characters; piece i
    of the text runs from ``at[i]`` to ``at[i + 1]``.

    After a chunk is emitted, pieces are dropped from its front until what
    is left is at most ``overlap`` long and leaves room for the next piece;
    the remainder starts the next chunk. Chunks are stripped; empty ones
    are skipped. Ends and starts are looked up, not walked to.
    """
    out: list[str] = []
    first, last = 0, len(at) - 1
    while first < last:
        end = max(bisect_right(at, at[first] + size, first) - 1, first + 1)
        chunk = text[at[first]:at[end]].strip()
        if chunk:
            out.append(chunk)
        if end == last:
            break
        first = max(bisect_left(at, at[end] - overlap, first, end), bisect_left(at, at[end + 1] - size, first, end))
    return out


def split_text(text, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> list[str]:
    """Split one text into overlapping chunks.

    Pieces are words with their leading space. Pieces shorter than ``size``
    are packed; a longer piece closes the current run and is itself cut on
    single characters. Text without any space is cut on characters.
    """
    if text is None:
        return []
    text = str(text)
    if size <= 0 or overlap < 0 or overlap > size:
        raise ValueError("need 0 <= overlap <= size and size > 0")
    if " " not in text:
        return _pack(text, range(len(text) + 1), size, overlap)
    ends = np.cumsum(np.fromiter(map(len, text.split(" ")), np.int64) + 1) - 1      # of words, where a space or nothing follows
    cuts = ends if text.startswith(" ") else np.append(0, ends)
    at = cuts.tolist()
    out: list[str] = []
    lo = 0
    for i in np.flatnonzero(np.diff(cuts) >= size).tolist():
        out.extend(_pack(text, at[lo:i + 1], size, overlap))
        out.extend(_pack(text, range(at[i], at[i + 1] + 1), size, overlap))
        lo = i + 1
    out.extend(_pack(text, at[lo:], size, overlap))
    return out


def _chunk_rows(carry: list[str], text_col: str, size: int, overlap: int):
    def run(batches):
        for batch in batches:
            for some in row_slices(batch, text_col):
                made = [split_text(t, size, overlap) for t in some.column(text_col).to_pylist()]
                count = np.array([len(m) for m in made], dtype=np.int64)
                row = pa.array(np.repeat(np.arange(len(made)), count))
                idx = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c).take(row) for c in carry), pa.array(idx.astype(np.int32)),
                     pa.array([c for m in made for c in m], pa.string())], [*carry, "idx", "chunk_text"])
    return run


def chunk_articles(articles: DataFrame, size: int = CHUNK_SIZE,
                   overlap: int = CHUNK_OVERLAP, text_col: str = "text",
                   keep: tuple[str, ...] = ("title",)) -> DataFrame:
    """Articles -> (article_id, *keep, idx, chunk_text), idx from 0 per article."""
    missing = {"article_id", text_col, *keep} - set(articles.columns)
    if missing:
        raise ValueError(f"the articles lack {', '.join(sorted(missing))}")
    carry = ["article_id", *keep]
    base = articles.select(*carry, F.col(text_col).cast("string").alias("_text"))
    schema = T.StructType([*(base.schema[c] for c in carry), T.StructField("idx", T.IntegerType()),
                           T.StructField("chunk_text", T.StringType())])
    return base.mapInArrow(lean(_chunk_rows(carry, "_text", size, overlap)), schema)


# ---------------------------------------------------------------- A5


def longest_overlap(left: str, right: str, max_length: int = CHUNK_OVERLAP) -> int:
    """Length of the longest suffix of ``left`` that is a prefix of ``right``
    (at most ``max_length``), by one prefix-function pass over
    right-head + separator + left-tail."""
    m = min(max_length, len(left), len(right))
    if m <= 0:
        return 0
    seq = [*right[:m], None, *left[len(left) - m:]]
    fail = [0] * len(seq)
    k = 0
    for i in range(1, len(seq)):
        while k and seq[i] != seq[k]:
            k = fail[k - 1]
        if seq[i] == seq[k]:
            k += 1
        fail[i] = k
    return fail[-1]


def rebuild(chunks, max_overlap: int = CHUNK_OVERLAP):
    """Fold ordered chunk texts into one text plus each chunk's [start, end).

    Each chunk is matched against the text so far: the longest shared
    suffix/prefix (at most ``max_overlap``) is dropped from the chunk; with
    none, the chunk is joined by one space. Only the last ``max_overlap``
    characters can match, so only that tail is kept while folding and the
    text is assembled once at the end (linear in the article length).
    """
    parts: list[str] = []
    spans = []
    tail = ""
    length = 0
    for i, piece in enumerate(chunks):
        piece = "" if piece is None else str(piece)
        if i == 0:
            start, add = 0, piece
        else:
            k = longest_overlap(tail, piece, max_overlap)
            start, add = (length - k, piece[k:]) if k else (length + 1, " " + piece)
        parts.append(add)
        length += len(add)
        tail = (tail + add)[-max_overlap:] if max_overlap > 0 else ""
        spans.append((start, start + len(piece)))
    return "".join(parts), spans


_REBUILT = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("position", T.IntegerType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ]))),
])


def _rebuild_udf(max_overlap: int):
    @F.pandas_udf(_REBUILT)
    def rebuild_rows(ordered: pd.Series) -> pd.DataFrame:
        texts, spans = [], []
        for items in ordered:
            positions = [int(it["position"]) for it in items]
            text, sp = rebuild([it["text"] for it in items], max_overlap)
            texts.append(text)
            spans.append([{"position": p, "start": s, "end": e}
                          for p, (s, e) in zip(positions, sp)])
        return pd.DataFrame({"text": texts, "spans": spans})
    return rebuild_rows


def reconstruct_articles(chunks: DataFrame, max_overlap: int = CHUNK_OVERLAP,
                         key: str = "article_id", position: str = "position",
                         text: str = "text") -> DataFrame:
    """Chunks (key, position, text) -> (key, text, spans).

    spans is an array of (position, start, end) into the rebuilt text.
    """
    grouped = chunks.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct(
            F.col(position).cast("int").alias("position"),
            F.col(text).alias("text")))).alias("_ordered"))
    rebuilt = grouped.select(key, _rebuild_udf(max_overlap)(F.col("_ordered")).alias("_r"))
    return rebuilt.select(key, F.col("_r.text").alias("text"), F.col("_r.spans").alias("spans"))
