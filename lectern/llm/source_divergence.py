"""How the sources of a language differ in their terms.

Terms are counted with Arrow's own kernels inside ``mapInArrow``: ascii_lower,
split_pattern_regex, dictionary_encode and a hash group_by give partial counts
per slice of texts; Spark merges them. Each language keeps the terms of enough
documents. The merged counts are dealt to columnar shards by term, and each
shard computes its part of the chi-square like divergences of all pairs of
sources, and the terms that stand out most in each source.

All numbers are whole: a term's share is p = 1 + floor(10^9 (count + 1) / (N + V))
and a divergence the sum of floor((p - q)^2 / q). A term that neither source of
a pair holds adds the same to the pair each time, so these are multiplied, not
visited; a shard's work grows with the counts that are not zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import lean, prepare, row_slices, shared_table

MIN_DOCS = 3
TOP = 200                   # terms that are reported of each source
SHARD_ROWS = 200_000        # counts in a shard, about
PAIRS = 1 << 19             # pairs of sources in the result of a shard, at most
_GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_HELD = 1 << 19             # partial counts that a task merges before it passes them on
_AT_ONCE = 1 << 20          # pairs of counts computed at once


def slice_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """(lang, source, term, n, docs): counts of a few texts."""
    lists = pc.split_pattern_regex(pc.ascii_lower(text), pattern=_GAP)
    words, row = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(words), 0)
    words, row = words.filter(some).dictionary_encode(), row.filter(some)
    of = pa.table({"lang": lang, "source": source})
    per_doc = pa.table({"row": row, "word": words.indices}).group_by(["row", "word"]).aggregate([([], "count_all")])
    named = of.take(per_doc["row"]).append_column("word", per_doc["word"]).append_column("n", per_doc["count_all"])
    sums = named.group_by(["lang", "source", "word"]).aggregate([("n", "sum"), ([], "count_all")])
    return pa.table({"lang": sums["lang"], "source": sums["source"],
                     "term": pa.chunked_array([c for c in pc.take(words.dictionary, sums["word"]).chunks], pa.string()),
                     "n": sums["n_sum"], "docs": sums["count_all"]})


def _merged(parts: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(parts).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table({"lang": t["lang"], "source": t["source"], "term": t["term"], "n": t["n_sum"], "docs": t["docs_sum"]})


def _count(batches):
    held, rows = [], 0
    for batch in batches:
        for some in row_slices(batch, "__text"):
            text = some.column("__text")
            held.append(slice_counts(some.column("lang"), some.column("source"), text))
            rows += held[-1].num_rows
            if rows > _HELD:
                held = [_merged(held)]
                rows = held[0].num_rows
                if rows > _HELD // 2:
                    yield from held.pop().combine_chunks().to_batches()
                    rows = 0
    if held:
        yield from _merged(held).combine_chunks().to_batches()


def shares(count: np.ndarray, total, vocabulary) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (total + vocabulary)), by long division so
    that no product leaves 64 bits."""
    rest, by = np.asarray(count) + 1, np.asarray(total) + vocabulary
    out = np.zeros(np.broadcast(rest, by).shape, dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // by
        rest = rest % by
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def pair_sums(source: np.ndarray, term: np.ndarray, n: np.ndarray, total: np.ndarray, vocabulary: int, n_terms: int,
              other: np.ndarray) -> np.ndarray:
    """Sums of ``divergence`` over a shard's ``n_terms`` terms, (all sources, sources of ``other``).

    Counts (source, term, n) that are not zero come in order of term. Each pair
    starts from all terms as if absent; then the terms of one side, grouped by
    equal counts, are put right, and last the terms that both sides hold.
    """
    zero = shares(np.zeros_like(total), total, vocabulary)
    base = divergence(zero[:, None], zero[other][None, :])
    out = base * n_terms
    place = np.full(len(total), -1)
    place[other] = np.arange(len(other))

    def alike(rows):
        values, times = np.unique(np.stack([source[rows], n[rows]]), axis=1, return_counts=True)
        return values[0], shares(values[1], total[values[0]], vocabulary), times
    step = max(1, _AT_ONCE // max(len(other), 1))
    s, p, times = alike(slice(None))
    for lo in range(0, len(s), step):
        cut = slice(lo, lo + step)
        more = (divergence(p[cut, None], zero[other][None, :]) - base[s[cut]]) * times[cut, None]
        np.add.at(out, s[cut], more)
    s, q, times = alike(place[source] >= 0)
    step = max(1, _AT_ONCE // max(len(total), 1))
    for lo in range(0, len(s), step):
        cut = slice(lo, lo + step)
        more = (divergence(zero[:, None], q[None, cut]) - base[:, place[s[cut]]]) * times[None, cut]
        np.add.at(out.T, place[s[cut]], more.T)
    # both sides hold the term: each count of an ``other`` source meets its term's whole run
    own = np.flatnonzero(place[source] >= 0)
    begin = np.searchsorted(term, term[own], side="left")
    size = np.searchsorted(term, term[own], side="right") - begin
    ends = np.cumsum(size)
    all_p, lo = shares(n, total[source], vocabulary), 0
    while lo < len(own):
        hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _AT_ONCE, side="right")), lo + 1)
        part = size[lo:hi]
        q_row = np.repeat(own[lo:hi], part)
        p_row = np.arange(len(q_row)) - np.repeat(np.cumsum(part) - part, part) + np.repeat(begin[lo:hi], part)
        a, b = source[p_row], source[q_row]
        p, q, p0, q0 = all_p[p_row], all_p[q_row], zero[a], zero[b]
        both = divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0)
        np.add.at(out, (a, place[b]), both)
        lo = hi
    return out


def top_terms(source: np.ndarray, term: np.ndarray, n: np.ndarray, total: np.ndarray, vocabulary: int, lang_total: int,
              own: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that stand out in a source of ``own``, their values): at most ``top``
    a source, by value, then in the order of ``term``, which is that of the names."""
    whole = np.zeros(int(term[-1]) + 1 if len(term) else 0, dtype=np.int64)
    np.add.at(whole, term, n)
    p, q = shares(n, total[source], vocabulary), shares(whole[term], lang_total, vocabulary)
    rows = np.flatnonzero((p > q) & np.isin(source, own))
    value = divergence(p[rows], q[rows])
    order = np.lexsort([term[rows], -value, source[rows]])
    rows, value = rows[order], value[order]
    first = np.searchsorted(source[rows], source[rows], side="left")
    near = np.arange(len(rows)) - first < top
    return rows[near], value[near]


def _shard(top: int):
    def run(counts: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        counts = counts.sort_by([("term", "ascending"), ("source", "ascending")])
        names = groups["source"].combine_chunks()
        total = groups["total"].to_numpy()
        vocabulary, lang_total = groups["vocabulary"][0].as_py(), groups["lang_total"][0].as_py()
        lang, head = groups["lang"][0].as_py(), groups["shard"][0].as_py() == 0
        own = np.flatnonzero(groups["own"].to_numpy())
        source = pc.index_in(counts["source"], names).to_numpy().astype(np.int64)
        terms = counts["term"].combine_chunks()
        coded = terms.dictionary_encode()                    # sorted: codes rise with the terms
        term, n = coded.indices.to_numpy().astype(np.int64), counts["n"].to_numpy()
        value = np.zeros((len(total), 0), dtype=np.int64)
        if len(term):
            value = pair_sums(source, term, n, total, vocabulary, len(coded.dictionary), own)
        elif head:                                           # a language without kept terms
            value = np.zeros((len(total), len(own)), dtype=np.int64)
        a, b = np.repeat(np.arange(len(total)), value.shape[1]), np.tile(own[:value.shape[1]], len(total))
        a, b, value = a[a != b], b[a != b], value.reshape(-1)[a != b]
        rows, best = top_terms(source, term, n, total, vocabulary, lang_total, own, top)
        return pa.table({
            "lang": pa.array([lang] * (len(a) + len(rows)), pa.string()),
            "source": pa.concat_arrays([names.take(pa.array(a)), names.take(pa.array(source[rows]))]),
            "part": pa.array(["pair"] * len(a) + ["term"] * len(rows), pa.string()),
            "item": pa.concat_arrays([names.take(pa.array(b)), terms.take(pa.array(rows))]),
            "value": pa.array(np.concatenate([value, best]))})
    return run


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs) of whole texts; nulls read as ''."""
    prepare(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "__text"))))
    partial = rows.mapInArrow(lean(_count), "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def source_divergences(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                       min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: the divergence of a source from each other source of its
    language, over all kept terms (0 where the language keeps none). Part
    ``term``: the ``top`` terms that a source uses more than its language does.
    Null lang, source and text read as ''; every (lang, source) that occurs
    takes part, also without terms; repeated rows count one by one. No
    documents, no rows.
    """
    spark = docs.sparkSession
    counts = shared_table(term_counts(docs, text_col, lang_col, source_col), "term_counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("__d")).filter(F.col("__d") >= min_docs)
    used = shared_table(counts.join(kept.select("lang", "term"), ["lang", "term"], "left_semi").drop("docs"), "kept_counts")
    langs = used.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.countDistinct("term").alias("vocabulary"))
    groups = shared_table(
        docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a)
                      for c, a in ((lang_col, "lang"), (source_col, "source")))).distinct()
        .join(used.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(langs, "lang", "left").fillna(0, ["total", "lang_total", "vocabulary"]), "sources")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    shards = max(1, -(-used.count() // SHARD_ROWS))
    blocks = max(1, -(-most * most // PAIRS))
    key = ["lang", "shard", "block"]
    dealt = used.withColumn("shard", F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sides = (groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
             .withColumn("own", F.pmod(F.xxhash64("source"), F.lit(blocks)) == F.col("block")))
    found = dealt.groupBy(key).cogroup(sides.groupBy(key)).applyInArrow(
        _shard(top), "lang string, source string, part string, item string, value long")
    whole = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    return whole.withColumn("rank", rank).filter((F.col("part") == "pair") | (F.col("rank") <= top))
