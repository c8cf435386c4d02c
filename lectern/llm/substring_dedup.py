"""Substring dedup: repeated windows of 35 words, merged and removed.

Rabin-Karp hashes of all windows of a text come from prefix sums. Counting
every one of them in Spark would shuffle more than the text itself, so the
windows that cannot repeat leave first, exactly: a window's anchor is its
smallest hash of 8 words (the leftmost of equals), equal windows have equal
anchors at equal offsets, so a window whose anchor occurs once occurs once. The
others are counted in Spark; repeated ones go back to their documents and merge
into maximal intervals.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import wordhash as W
from lectern.llm.common import (counted, in_sieve, load_sieve, mark_in_sieve, prepare, shared_table, sieve_rows,
                                sieve_slot, text_slices)

WINDOW = 35
ANCHOR = 8                 # words of an anchor


def _anchors(sub: np.ndarray, at: np.ndarray, window_starts: np.ndarray, reach: int) -> np.ndarray:
    """For each window, the index into ``sub`` of its anchor: the smallest of
    the ``reach`` hashes that begin in it, the leftmost of equals."""
    bits = np.uint64(max(26, len(sub).bit_length()))
    value = (sub >> bits << bits) | np.arange(len(sub), dtype=np.uint64)
    span = 1
    while span * 2 <= reach:
        value = np.minimum(value[:len(value) - span], value[span:])
        span *= 2
    begin = np.searchsorted(at, window_starts)
    best = np.minimum(value[begin], value[begin + reach - span])
    return (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _slices(batches, text_col: str, window: int, anchor: int):
    """Per slice: batch, rows, window starts, first word of each text, the
    anchor's index for each window and the hashes of all anchors' places."""
    for batch in batches:
        for lo, hi, buf, off in text_slices(batch, text_col):
            starts, ends, first = W.find_words(buf, off, W.NOT_SPACE)
            words = W.run_hashes(buf, starts, ends)
            at, sub = W.windows(words, first, anchor)
            win, hashes = W.windows(words, first, window)
            if len(win):
                yield batch, lo, hi, first, win, hashes, sub, _anchors(sub, at, win, window - anchor + 1)


def _count_anchors(text_col: str, window: int, anchor: int):
    def run(batches):
        yield from counted(sub[np.unique(best)] for *_, sub, best in _slices(batches, text_col, window, anchor))
    return run


def _count_windows(text_col: str, window: int, anchor: int, repeated):
    def run(batches):
        flat = repeated.value
        yield from counted(hashes[in_sieve(flat, sub)[best]]
                           for *_, hashes, sub, best in _slices(batches, text_col, window, anchor))
    return run


def _places(text_col: str, window: int, anchor: int, anchors, repeated):
    """(hash, key of the text, window number) of the windows that may repeat."""
    def run(batches):
        for batch, lo, hi, first, win, hashes, sub, best in _slices(batches, text_col, window, anchor):
            take = np.flatnonzero(in_sieve(anchors.value, sub)[best])
            take = take[in_sieve(repeated.value, hashes[take])]
            doc = np.searchsorted(first, win[take], side="right") - 1
            key = batch.column("__key")[lo:hi].to_numpy(zero_copy_only=False)
            for i in range(0, len(take), 1 << 18):
                part = slice(i, i + (1 << 18))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[take[part]].view(np.int64)), pa.array(key[doc[part]]),
                     pa.array((win[take[part]] - first[doc[part]]).astype(np.int32))], ["h", "__key", "at"])
    return run


def _remove(id_col: str, text_col: str, window: int):
    """Merge the repeated windows of each text and cut them out."""
    def run(batches):
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, text_col):
                data = buf.tobytes()
                n_words, kept, bounds, begins, ends = [], [], [0], [], []
                for i, places in enumerate(batch.column("places")[lo:hi]):
                    words = data[off[i]:off[i + 1]].split()
                    n_words.append(len(words))
                    if places.is_valid and len(places.values):
                        at = np.unique(places.values.to_numpy())
                        cut = np.flatnonzero(np.diff(at) > window)      # words between two windows stay
                        lows, highs = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + window
                        stay = np.ones(len(words), dtype=bool)
                        for a, b in zip(lows, highs):
                            stay[a:b] = False
                        begins.extend(lows)
                        ends.extend(highs)
                        words = compress(words, stay)
                    kept.append(b" ".join(words))
                    bounds.append(len(begins))
                spans = pa.StructArray.from_arrays(
                    [pa.array(begins, type=pa.int32()), pa.array(ends, type=pa.int32())], ["start", "end"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col)[lo:hi], pa.array(n_words, type=pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), spans),
                     pa.array(kept, type=pa.binary()).cast(pa.string())],
                    [id_col, "n_words", "removed", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(id, n_words, removed, kept_text, n_removed) per document row.

    ``removed`` holds maximal word intervals [start, end); ``kept_text`` the
    other words joined by one blank. Null texts are empty; texts of fewer words
    than the window keep all. Repeated rows repeat each other's windows, as do
    documents with equal texts. Other columns are ignored; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    anchor = min(anchor, window)
    source = docs.select(id_col, text_col, F.xxhash64(id_col, text_col).alias("__key"))
    texts = source.select(text_col)
    twice = F.sum("n") > 1
    anchors = load_sieve(sieve_rows(
        texts.mapInArrow(_count_anchors(text_col, window, anchor), "h long, n long")
        .groupBy("h").agg(twice.alias("many")).filter("many").select(sieve_slot(F.col("h")).alias("s")), "s"))
    repeated = shared_table(
        texts.mapInArrow(_count_windows(text_col, window, anchor, anchors), "h long, n long")
        .groupBy("h").agg(twice.alias("many")).filter("many").select("h"), "repeated")
    sieve = load_sieve(sieve_rows(repeated.select(sieve_slot(F.col("h")).alias("s")), "s"))
    places = shared_table(
        source.select(text_col, "__key")
        .mapInArrow(_places(text_col, window, anchor, anchors, sieve), "h long, __key long, at int")
        .join(repeated, "h", "left_semi")
        .groupBy("__key").agg(F.collect_set("at").alias("places")), "places")

    # only texts that lose words meet their places; the others are never shuffled
    keys = spark.createDataFrame(
        sieve_rows(places.select(sieve_slot(F.col("__key")).alias("s")), "s").collect(), "part long, bitmap binary")
    marked = mark_in_sieve(source, sieve_slot(F.col("__key")), keys, "__hit")
    cut = marked.filter("__hit").join(places, "__key", "left").select(id_col, text_col, "places")
    whole = marked.filter(~F.col("__hit")).select(
        id_col, text_col, F.lit(None).cast("array<int>").alias("places"))
    schema = (f"{id_col} {dict(docs.dtypes)[id_col]}, n_words long, "
              "removed array<struct<start:int,end:int>>, kept_text string")
    return (whole.unionByName(cut).mapInArrow(_remove(id_col, text_col, window), schema)
            .withColumn("n_removed", F.aggregate(
                "removed", F.lit(0).cast("long"), lambda s, r: s + (r["end"] - r["start"]).cast("long"))))
