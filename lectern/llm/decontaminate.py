"""Benchmark decontamination with suffix arrays over the training text.

A slice of documents is one training shard. Its words become ids of the
benchmark's vocabulary (0: a word the benchmark lacks, or a document's end),
and the suffixes that could begin a match are sorted into a suffix array. Every
test suffix of at least a window is looked up by binary search, and suffixes are
then compared beyond the window, which gives the longest verbatim match from
each place. A suffix is left out of the array only if some pair of its first
words never occurs in the benchmark, so nothing that matches is lost.

The benchmark is the query set: it is cut into blocks of bounded size, one pass
over the documents for each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import wordhash as W
from lectern.llm.common import lean, prepare, shared_table, text_slices

WINDOW = 10
BLOCK_BYTES = 4 << 20      # benchmark text of one pass
_PAIR_BITS = 22
_OUT = "{id} {id_type}, __key long, n_words long, matches array<struct<start:int,end:int,item_id:string,item_start:int>>, items array<string>"


class _Block:
    """One block of the benchmark: vocabulary, word pairs and test suffixes.

    ``tests`` lists the suffixes of at least a window (of a shorter item: the whole)
    in suffix order, so those that share a window are neighbours, and so are those
    that share more. ``sets`` numbers the distinct sets of items of the windows."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = [(t or "").encode() for _, t in items]
        buf = W.LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        starts, ends, first = W.find_words(buf, off, W.ALNUM)
        words = W.run_hashes(buf, starts, ends)
        self.window = window
        self.names = [name for name, _ in items]
        self.vocabulary = np.unique(words)
        self.words = self.ids(words)
        self.total = W.prefix_sums(self.words)
        self.item = np.repeat(np.arange(len(items)), np.diff(first))
        self.at = np.arange(len(words)) - first[self.item]
        self.left = first[self.item + 1] - np.arange(len(words))       # words to the item's end
        tests = np.flatnonzero((self.left >= window) | (self.at == 0))
        self.tests = tests[np.argsort(_suffix_ranks(self.words, self.left)[tests], kind="stable")]
        inside = np.arange(window) < self.left[self.tests][:, None]
        padded = np.concatenate([self.words, np.zeros(window, dtype=np.int64)])
        keys = np.where(inside, padded[self.tests[:, None] + np.arange(window)], 0)
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        head = np.flatnonzero(new)
        self.bounds = np.append(head, len(keys))
        self.keys, self.sizes = keys[head], np.minimum(self.left[self.tests[head]], window)
        self.low = _packed(self.keys)
        self.high = _packed(np.where(np.arange(window) < self.sizes[:, None], self.keys, 0xFFFFFFFF))
        self.least = int(self.sizes.min()) if len(self.sizes) else 0
        self._item_sets(np.cumsum(new) - 1)
        self.pairs = np.zeros(1 << _PAIR_BITS, dtype=bool)
        for j in range(window - 1):
            inside = self.sizes > j + 1
            self.pairs[self._slot(self.keys[inside, j], self.keys[inside, j + 1])] = True

    def _item_sets(self, group: np.ndarray) -> None:
        n = max(len(self.names), 1)
        both = np.unique(group * n + self.item[self.tests])
        group, self.members = both // n, both % n
        lo = np.searchsorted(group, np.arange(len(self.keys)))
        hi = np.searchsorted(group, np.arange(len(self.keys)), side="right")
        marks = np.zeros(len(both) + 1, dtype=np.uint64)
        np.cumsum(W.mix(self.members.astype(np.uint64) + np.uint64(1)), out=marks[1:])
        _, head, number = np.unique(marks[hi] - marks[lo], return_index=True, return_inverse=True)
        self.sets = number.reshape(-1)
        self.set_lo, self.set_hi = lo[head], hi[head]

    def ids(self, words: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(words), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at + 1, 0)

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = W.mix((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))
        return (h >> np.uint64(64 - _PAIR_BITS)).astype(np.int64)

    def suffixes(self, stream: np.ndarray) -> np.ndarray:
        """Positions where a window of the shortest size may begin."""
        if not self.least:
            return np.zeros(0, dtype=np.int64)
        good = stream > 0
        if self.least == 1:
            return np.flatnonzero(good)
        linked = good[:-1] & good[1:]
        at = np.flatnonzero(linked)
        linked[at] = self.pairs[self._slot(stream[at], stream[at + 1])]
        bad = np.zeros(len(linked) + 1, dtype=np.int64)
        np.cumsum(~linked, out=bad[1:])
        span = self.least - 1
        return np.flatnonzero(bad[span:] == bad[:len(bad) - span])

    def search(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, window numbers) of all occurrences in the shard."""
        at = self.suffixes(stream)
        if not len(at):
            return at, at
        padded = np.concatenate([stream, np.zeros(self.window, dtype=np.int64)])
        keys = _packed(np.lib.stride_tricks.sliding_window_view(padded, self.window)[at])
        order = np.argsort(keys, kind="stable")
        array, sorted_keys = at[order], keys[order]
        asked = np.flatnonzero(np.isin(self.keys[:, 0], stream[at]))
        lo = np.searchsorted(sorted_keys, self.low[asked], side="left")
        hi = np.searchsorted(sorted_keys, self.high[asked], side="right")
        hits, which = _ranges(lo, np.maximum(hi, lo))
        return array[hits], asked[which]

    def extend(self, stream: np.ndarray, pos: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, test suffix) of the longest match of any test suffix from each
        place that a window was found at. The suffix of the shard is placed among the
        test suffixes of its window by binary search: the one that shares most with it
        is a neighbour of its place."""
        total = W.prefix_sums(stream)
        lo, hi = self.bounds[window].copy(), self.bounds[window + 1].copy()
        size, best = self.sizes[window].copy(), self.tests[lo]
        hi[size < self.window] = 0                                      # a short item is matched whole
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) // 2
            test, p = self.tests[mid], pos[live]
            n = W.common_runs(total, p, self.total, test, self.window, np.minimum(len(stream) - p, self.left[test]))
            longer = n > size[live]
            size[live[longer]], best[live[longer]] = n[longer], test[longer]
            here = np.where(p + n < len(stream), stream[np.minimum(p + n, len(stream) - 1)], 0)
            there = np.where(n < self.left[test], self.words[np.minimum(test + n, len(self.words) - 1)], 0)
            lo[live] = np.where(there < here, mid + 1, lo[live])
            hi[live] = np.where(there < here, hi[live], mid)
            live = live[lo[live] < hi[live]]
        return size, best


def _suffix_ranks(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes of all items, by words; equal suffixes share a rank
    and one that ends comes before those that go on. By doubling."""
    rank, step, place = words, 1, np.arange(len(words))
    while step < (left.max() if len(left) else 0):
        after = np.zeros(len(words), dtype=np.int64)
        on = np.flatnonzero(left > step)
        after[on] = rank[place[on] + step]
        rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1].reshape(-1) + 1
        step *= 2
    return rank


def _packed(ids: np.ndarray) -> np.ndarray:
    """Rows of ids as byte strings that compare like the rows."""
    rows = np.ascontiguousarray(ids.astype(">u4"))
    return rows.view(f"S{4 * rows.shape[1]}").reshape(-1) if len(rows) else np.zeros(0, dtype=f"S{4 * ids.shape[1]}")


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members of the ranges lo[i]:hi[i], and the i of each."""
    n = hi - lo
    which = np.repeat(np.arange(len(lo)), n)
    shift = np.cumsum(n) - n
    return np.arange(int(n.sum())) - shift[which] + lo[which], which


def _matches(block: _Block, ids: np.ndarray, first: np.ndarray) -> tuple[tuple, tuple]:
    """((text, start, end, item, item start) of the maximal matches of a shard,
    (text, item) of all items with a window there), both in order of the text.

    Work and memory grow with the places that are hit, and with the items of a text,
    not with places times items: windows that share their items count them once."""
    n_docs = len(first) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    stream = np.zeros(len(ids) + n_docs, dtype=np.int64)
    stream[np.arange(len(ids)) + doc] = ids
    pos, window = block.search(stream)
    text = np.searchsorted(first + np.arange(n_docs + 1), pos, side="right") - 1
    n_sets, n_items = max(len(block.set_lo), 1), max(len(block.names), 1)
    own = np.unique(text * n_sets + block.sets[window])
    member, which = _ranges(block.set_lo[own % n_sets], block.set_hi[own % n_sets])
    held = np.unique((own // n_sets)[which] * n_items + block.members[member])
    size, test = block.extend(stream, pos, window)
    order = np.lexsort((-size, pos))
    pos, text, size, test = pos[order], text[order], size[order], test[order]
    end = pos + size
    whole = np.ones(len(pos), dtype=bool)
    whole[1:] = end[1:] > np.maximum.accumulate(end)[:-1]              # ends beyond all that began before
    pos, text, size, test = pos[whole], text[whole], size[whole], test[whole]
    start = pos - text - first[text]
    return (text, start, start + size, block.item[test], block.at[test]), (held // n_items, held % n_items)


def _pass(blocks: list, id_col: str, text_col: str, only_hits: bool):
    def run(batches):
        block = blocks[0].value
        names = pa.array(block.names, type=pa.string())
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, text_col):
                buf = W.LOWER[buf]
                starts, ends, first = W.find_words(buf, off, W.ALNUM)
                ids = block.ids(W.run_hashes(buf, starts, ends))
                (text, start, end, item, at), (of, held) = _matches(block, ids, first)
                bounds = np.searchsorted(text, np.arange(hi - lo + 1))
                found = pa.StructArray.from_arrays(
                    [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)),
                     names.take(pa.array(item)), pa.array(at.astype(np.int32))],
                    ["start", "end", "item_id", "item_start"])
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), found)
                item_lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of, np.arange(hi - lo + 1)).astype(np.int32)), names.take(pa.array(held)))
                out = pa.RecordBatch.from_arrays(
                    [batch.column(id_col)[lo:hi], batch.column("__key")[lo:hi],
                     pa.array(np.diff(first).astype(np.int64)), lists, item_lists],
                    [id_col, "__key", "n_words", "matches", "items"])
                if only_hits:
                    out = out.filter(pa.array(np.diff(bounds) > 0))
                yield out
    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, limit: int) -> list:
    """The benchmark as broadcast blocks of at most ``limit`` bytes of text."""
    sc = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), text_col)
    made, items, size = [], [], 0
    for name, text in rows.toLocalIterator():
        if items and size + len(text or "") > limit:
            made.append(sc.broadcast(_Block(items, window)))
            items, size = [], 0
        items.append((name, text))
        size += len(text or "")
    return [*made, sc.broadcast(_Block(items, window))]


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_words, n_hit, items, longest, matches, contaminated) per document row.

    ``matches`` holds each maximal verbatim match (of a block of the benchmark) with
    its word offsets in the document and in one item that holds it, however many
    do; ``items`` holds the distinct ids of all items with a window in the text, in
    string order, ``longest`` the words of the longest match. Null or wordless texts have no
    words and no hits; an item without words never matches; a null item id
    counts as an empty string; items that share an id or a text are all found.
    Repeated document rows each get a row. Other columns are ignored. An empty
    benchmark contaminates nothing.
    """
    prepare(docs.sparkSession)
    blocks = _blocks(benchmark, item_col, item_text_col, window, block_bytes)
    source = docs.select(id_col, F.xxhash64(id_col, text_col).alias("__key"), text_col)
    schema = _OUT.format(id=id_col, id_type=dict(docs.dtypes)[id_col])
    found = source.mapInArrow(lean(_pass(blocks[:1], id_col, text_col, False)), schema)
    if len(blocks) > 1:
        # the hits of the other blocks; rows equal in id and text have equal hits
        more = [shared_table(source.mapInArrow(lean(_pass([b], id_col, text_col, True)), schema)
                             .select("__key", "matches", "items").dropDuplicates(["__key"]), "hits") for b in blocks[1:]]
        union = more[0]
        for m in more[1:]:
            union = union.unionByName(m)
        union = union.groupBy("__key").agg(*[F.flatten(F.collect_list(c)).alias(f"__{c}") for c in ("matches", "items")])
        found = found.join(union, "__key", "left").withColumns({
            c: F.array_sort(F.concat(c, F.coalesce(f"__{c}", F.array().cast(found.schema[c].dataType)))) for c in ("matches", "items")})
    n_hit = F.aggregate(
        "matches", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda s, m: F.struct((s["n"] + F.greatest(F.lit(0), m["end"] - F.greatest(m["start"], s["end"]))).alias("n"),
                              F.greatest(s["end"], m["end"]).alias("end")),
        lambda s: s["n"].cast("long"))
    return found.select(
        id_col, "n_words", n_hit.alias("n_hit"),
        F.array_sort(F.array_distinct("items")).alias("items"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["end"] - m["start"])), F.lit(0)).alias("longest"),
        "matches").withColumn("contaminated", F.col("n_hit") > 0)
