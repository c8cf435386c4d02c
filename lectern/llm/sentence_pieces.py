"""SentencePiece encoding by forward filtering, backward sampling; lossless decoding.

A text is cut before each run of blanks and around each line break, where no piece
runs on. In the lattice of a segment an edge is a piece of the vocabulary or, at a
low weight, a single byte.
Forward filtering sums the weights of all paths to every position; backward
sampling draws the last piece from the exact distribution, then the one before
it, down to the start. The random numbers are a hash of the row's key and the
place in the text, so a row's segmentation can be repeated anywhere. Pieces
spell the text's bytes exactly, so decoding returns the text.

All short segments of a slice are handled at once: the lattice is built for distinct
segments, the sampling walks all occurrences in step. A long segment (a script
without blanks, say) keeps the sum of each position alone; its edges are made a
block at a time, once on the way forth and once on the way back. Both draw by the
same rule.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import wordhash as W
from lectern.llm.common import lean, prepare, text_slices

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
TEMPERATURE = 1.0          # weights are raised to 1 / TEMPERATURE
_BYTE_WEIGHT = -14.0       # log weight of a byte that stands for itself
_LONG = 48                 # bytes up to which lattices are built together
_SLICE = 1 << 17           # bytes of text encoded at once: lattices take some hundred times their unique segments
_BLOCK = 1 << 14           # bytes of a long segment whose edges are held at once
_LEVEL = 2.4               # log weights are raised by this for each byte, which cancels and keeps sums near 1
_PIECES = 1 << 17          # pieces decoded at once
_FILTER_BITS = 18
_FILTER = np.uint64((1 << _FILTER_BITS) - 1)
_MARK = "▁"           # the vocabulary's sign for a blank


class Vocabulary:
    """Pieces as bytes, their ids and weights. A piece of rank r weighs 1 / (2 + r)."""

    def __init__(self, pieces: list[tuple[int, bytes]], byte_ids: list[int], temperature: float = TEMPERATURE):
        self.byte_ids = np.array(byte_ids, dtype=np.int32)
        logs = {p: (-np.log(2.0 + rank) / temperature, i) for rank, (i, p) in enumerate(pieces)}
        self.by_length: dict[int, tuple[np.ndarray, ...]] = {}
        self.pieces = logs
        self.spelled = {i: p for i, p in pieces} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        for n in sorted({len(p) for p in logs}):
            own = [p for p in logs if len(p) == n]
            buf = np.frombuffer(b"".join(own), dtype=np.uint8)
            lo = np.arange(len(own)) * n
            h = W.run_hashes(buf, lo, lo + n)
            order = np.argsort(h)
            some = np.zeros(1 << _FILTER_BITS, dtype=bool)
            some[(h & _FILTER).astype(np.int64)] = True
            self.by_length[n] = (h[order], np.array([logs[p][0] for p in own])[order],
                                 np.array([logs[p][1] for p in own], dtype=np.int32)[order], some)
        self._longest = np.zeros(1 << 16, dtype=np.uint8)
        for p in logs:
            heads = [p[0] | b << 8 for b in range(256)] if len(p) == 1 else [p[0] | p[1] << 8]
            self._longest[heads] = np.maximum(self._longest[heads], min(len(p), 255))

    def longest(self, buf: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Bytes of the longest piece that begins with the two bytes at each place."""
        after = buf[np.minimum(place + 1, len(buf) - 1)].astype(np.int32)
        return self._longest[buf[place] | after << 8]

    def find(self, buf: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which places begin a piece of n bytes, its weight, its id)."""
        known, weight, piece, some = self.by_length[n]
        h = W.run_hashes_of(buf, place, n)
        may = np.flatnonzero(some[(h & _FILTER).astype(np.int64)])
        spot = np.minimum(np.searchsorted(known, h[may]), len(known) - 1)
        hit = known[spot] == h[may]
        return may[hit], weight[spot[hit]], piece[spot[hit]]

    @classmethod
    def load(cls, model_file: str = MODEL_FILE, temperature: float = TEMPERATURE) -> Vocabulary:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.vocab_size())
        pieces = [(i, model.id_to_piece(i).replace(_MARK, " ").encode()) for i in ids
                  if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        return cls(pieces, [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], temperature)


def _segments(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where segments begin: at texts, runs of blanks, line breaks and behind those.
    Pieces hold blanks in front alone, or nothing but blanks."""
    begin = (buf == 32) | (buf == 10)
    begin[1:] &= (buf[1:] == 10) | (buf[:-1] != 32)
    begin[1:] |= buf[:-1] == 10
    begin[off[:-1][off[:-1] < len(buf)]] = True
    return np.flatnonzero(begin)


def _edges(vocab: Vocabulary, buf: np.ndarray, place: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, ...]:
    """(number of the place, bytes, weight, id) of all edges from the places, none
    of more than ``room`` bytes: single bytes first, then pieces by length."""
    at = np.arange(len(place), dtype=np.int32)
    # no piece from here is longer than the longest with the same two bytes
    reach = np.minimum(room, vocab.longest(buf, place))
    froms, sizes = [at], [np.ones(len(at), dtype=np.int32)]
    logs, ids = [np.full(len(at), _BYTE_WEIGHT)], [vocab.byte_ids[buf[place]]]
    for n in sorted(vocab.by_length):
        at = at[reach[at] >= n]
        hit, weight, piece = vocab.find(buf, place[at], n)
        froms.append(at[hit])
        sizes.append(np.full(len(hit), n, dtype=np.int32))
        logs.append(weight)
        ids.append(piece)
    return np.concatenate(froms), np.concatenate(sizes), np.concatenate(logs), np.concatenate(ids)


def _likely_first(share: np.ndarray, target: np.ndarray, n_nodes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the edges by node, likely ones first; where each node's begin; their
    cumulated probabilities)."""
    order = np.argsort(target + (1.0 - share) * 0.999)
    share = share[order]
    first = np.concatenate([[0], np.cumsum(np.bincount(target, minlength=n_nodes))])
    count = np.diff(first)
    begin, last = first[:-1][count > 0], first[1:][count > 0] - 1
    summed = np.cumsum(share)
    key = summed - np.repeat((summed - share)[begin], count[count > 0])
    key[last] = 2.0                                         # rounding must not leave a gap
    return order, first, key


def _draw(first: np.ndarray, key: np.ndarray, node: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The edge into each node that the uniform numbers choose."""
    edge = first[node]
    more = np.flatnonzero(key[edge] <= u)
    while len(more):
        edge[more] += 1
        more = more[key[edge[more]] <= u[more]]
    return edge


class _Lattice:
    """The lattices of several segments as one table of edges.

    Nodes are byte positions: base[s] is the begin of segment s and
    base[s] + its length the end. The edges into node v are first[v] to
    first[v + 1], likely ones first, with cumulated probabilities.
    """

    def __init__(self, vocab: Vocabulary, buf: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        size = (hi - lo).astype(np.int32)
        self.base = (np.cumsum(size + 1) - (size + 1)).astype(np.int32)
        self.end = self.base + size
        n_nodes = int((size + 1).sum())
        seg = np.repeat(np.arange(len(lo), dtype=np.int32), size)
        depth = (np.arange(len(seg), dtype=np.int32) - np.repeat((np.cumsum(size) - size).astype(np.int32), size))
        at, step, log, piece = _edges(vocab, buf, lo[seg] + depth, size[seg] - depth)
        source = (self.base[seg] + depth)[at]
        target, deep = source + step, (depth[at] + step).astype(np.uint8)
        weight = np.exp(log + _LEVEL * step)
        total = np.zeros(n_nodes)
        total[self.base] = 1.0
        turn = np.argsort(deep, kind="stable")              # forward filtering, one depth at a time
        cuts = np.cumsum(np.bincount(deep, minlength=1))
        path = np.zeros(len(source))
        for a, b in zip(cuts[:-1], cuts[1:]):
            e = turn[a:b]
            path[e] = total[source[e]] * weight[e]
            np.add.at(total, target[e], path[e])
        order, self.first, self.key = _likely_first(path / total[target], target, n_nodes)
        self.source, self.piece = source[order], piece[order]


def _uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from the row's seed and a place in the text. 26 bits
    are kept, so that adding a node number loses none of them."""
    h = W.mix(seed.astype(np.uint64) ^ W.mix(place.astype(np.uint64)))
    return (h >> np.uint64(38)).astype(np.float64) / float(1 << 26)


def _forward_long(vocab: Vocabulary, buf: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Logarithm of the summed weights of all paths from lo to each place up to hi."""
    most = max(vocab.by_length)
    logs = np.empty(hi - lo + 1)
    sums, level = [1.0] + [0.0] * most, 0.0                 # the sums of the next places, as far as they are known
    for a in range(lo, hi, _BLOCK):
        place = np.arange(a, min(a + _BLOCK, hi))
        at, step, log, _ = _edges(vocab, buf, place, hi - place)
        order = np.argsort(at, kind="stable")
        steps, weights = step[order].tolist(), np.exp(log + _LEVEL * step)[order].tolist()
        cuts = np.cumsum(np.bincount(at, minlength=len(place))).tolist()
        sums += [0.0] * len(place)
        seen, levels, e = [], [], 0
        for i, cut in enumerate(cuts):
            x = sums[i]
            if not 1e-100 < x < 1e100:
                for j in range(i, i + most + 1):
                    sums[j] /= x
                level += math.log(x)
                x = 1.0
            seen.append(x)
            levels.append(level)
            while e < cut:
                sums[i + steps[e]] += x * weights[e]
                e += 1
        logs[a - lo:a - lo + len(place)] = np.log(seen) + levels
        sums = sums[len(place):]
    logs[hi - lo] = math.log(sums[0]) + level
    return logs


def _sample_long(vocab: Vocabulary, buf: np.ndarray, lo: int, hi: int, seed: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ids) of the pieces of one long segment of the text that begins at ``start``."""
    most = max(vocab.by_length)
    logs = _forward_long(vocab, buf, lo, hi)
    where, what, end = [], [], hi
    while end > lo:
        a = max(lo, end - _BLOCK)                           # the nodes a + 1 to end
        place = np.arange(max(lo, a + 1 - most), end)
        at, step, log, piece = _edges(vocab, buf, place, hi - place)
        target = place[at] + step
        own = np.flatnonzero((target > a) & (target <= end))
        source, target, piece = place[at[own]], target[own], piece[own]
        share = np.exp(logs[source - lo] + log[own] + _LEVEL * step[own] - logs[target - lo])
        order, first, key = _likely_first(share, target - a - 1, end - a)
        node = np.arange(end - a)
        edge = order[_draw(first, key, node, _uniform(np.array([seed], dtype=np.uint64), node + (a + 1 - start)))]
        before, picks, base = source[edge].tolist(), [], a + 1
        while end > a:
            picks.append(end - base)
            end = before[end - base]
        edge = edge[picks]
        where.append(source[edge])
        what.append(piece[edge])
    return np.concatenate(where), np.concatenate(what)


def encode_slice(vocab: Vocabulary, buf: np.ndarray, off: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all texts, bounds of each text's ids)."""
    lo = _segments(buf, off)
    hi = np.append(lo[1:], len(buf))
    text = np.searchsorted(off, lo, side="right") - 1
    hashes = W.run_hashes(buf, lo, hi)
    size = hi - lo
    where, what = [], []                                    # begin of each piece in the slice, its id
    short = np.flatnonzero(size <= _LONG)
    # a very long text is a slice alone: its segments are taken a slice's bytes at a time
    parts = np.flatnonzero(np.diff(np.cumsum(size[short]) // _SLICE, prepend=-1)) if len(short) else []
    for own in np.split(short, parts[1:]) if len(short) else []:
        _, pick, back = np.unique(hashes[own], return_index=True, return_inverse=True)
        table = _Lattice(vocab, buf, lo[own][pick], hi[own][pick])
        node, floor = table.end[back.reshape(-1)], table.base[back.reshape(-1)]
        shift, seed, start = lo[own] - floor, seeds[text[own]], off[text[own]]
        while len(node):
            edge = _draw(table.first, table.key, node, _uniform(seed, node + shift - start))
            node = table.source[edge]
            where.append(node + shift)
            what.append(table.piece[edge])
            go = node > floor
            node, floor, shift, seed, start = node[go], floor[go], shift[go], seed[go], start[go]
    for s in np.flatnonzero(size > _LONG).tolist():
        begins, ids = _sample_long(vocab, buf, int(lo[s]), int(hi[s]), int(seeds[text[s]]), int(off[text[s]]))
        where.append(begins)
        what.append(ids)
    if not where:
        return np.zeros(0, dtype=np.int32), np.zeros(len(off), dtype=np.int64)
    # the begins are distinct places of the slice: marking them sorts the pieces
    at = np.full(len(buf), -1, dtype=np.int32)
    at[np.concatenate(where)] = np.concatenate(what)
    used = np.flatnonzero(at >= 0)
    return at[used], np.searchsorted(used, off)


def _seed(keys: pa.Array) -> np.ndarray:
    return W.mix(keys.to_numpy(zero_copy_only=False).view(np.uint64))


def _encode(vocab_bc, text_col: str):
    def run(batches):
        vocab = vocab_bc.value
        for batch in batches:
            names = [n for n in batch.schema.names if n != "__seed"]
            for lo, hi, buf, off in text_slices(batch, text_col, _SLICE):
                ids, bounds = encode_slice(vocab, buf, off, _seed(batch.column("__seed")[lo:hi]))
                valid = batch.column(text_col)[lo:hi].is_valid()
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                lists = lists if valid.false_count == 0 else pc.if_else(valid, lists, pa.scalar(None, lists.type))
                yield pa.RecordBatch.from_arrays([*(batch.column(n)[lo:hi] for n in names), lists], [*names, "pieces"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL_FILE,
           temperature: float = TEMPERATURE, seed: int = 0) -> DataFrame:
    """``docs`` with the column pieces (array of ids), one sampled segmentation.

    The draw depends on ``seed``, the row's id and the text alone: repeated rows
    and a null id get the same segmentation each time. A null text has null
    pieces, an empty one none. A column named pieces is replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("pieces", "__seed")
    vocab = spark.sparkContext.broadcast(Vocabulary.load(model_file, temperature))    # as large as the vocabulary
    rows = docs.withColumn("__seed", F.xxhash64(F.lit(seed), F.col(id_col)))
    schema = T.StructType([*docs.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(lean(_encode(vocab, text_col)), schema)


def _decode(spelled_bc, pieces_col: str, out_col: str):
    def few(batches):
        """Rows of at most _PIECES pieces, or one row of more."""
        for batch in batches:
            ends = np.cumsum(np.nan_to_num(pc.list_value_length(batch.column(pieces_col)).to_numpy(zero_copy_only=False)))
            lo = 0
            while lo < batch.num_rows:
                hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _PIECES, side="right")), lo + 1)
                yield batch.slice(lo, hi - lo)
                lo = hi

    def run(batches):
        data, off = spelled_bc.value
        for batch in few(batches):
            lists = batch.column(pieces_col)
            ids = lists.flatten().to_numpy()
            counts = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            size = off[ids + 1] - off[ids]
            ends = np.concatenate([[0], np.cumsum(size)])
            source = np.repeat(off[ids] - ends[:-1], size) + np.arange(int(ends[-1]))
            texts = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(ends[bounds])), pa.py_buffer(data[source])])
            texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, texts.type)).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, out_col])
    return run


def _spelled(spark, model_file: str):
    """The bytes of all pieces, one after the other, and where each begins."""
    spelled = Vocabulary.load(model_file).spelled
    texts = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
    return spark.sparkContext.broadcast(
        (np.frombuffer(b"".join(texts), dtype=np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])))


def decode(rows: DataFrame, pieces_col: str = "pieces", out_col: str = "decoded",
           model_file: str = MODEL_FILE) -> DataFrame:
    """``rows`` with the text that the pieces spell; null pieces give null."""
    spark = rows.sparkSession
    prepare(spark)
    rows = rows.drop(out_col)
    return rows.mapInArrow(lean(_decode(_spelled(spark, model_file), pieces_col, out_col)),
                           T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())]))


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str = MODEL_FILE,
                      temperature: float = TEMPERATURE, seed: int = 0) -> DataFrame:
    """``docs`` with the columns pieces and decoded, as ``decode(encode(docs))``, but in
    one pass: a task keeps one Python worker, not two."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("pieces", "decoded", "__seed")
    forth = _encode(spark.sparkContext.broadcast(Vocabulary.load(model_file, temperature)), text_col)
    back = _decode(_spelled(spark, model_file), "pieces", "decoded")

    def run(batches):
        yield from back(forth(batches))
    schema = T.StructType([*docs.schema.fields, T.StructField("pieces", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    return docs.withColumn("__seed", F.xxhash64(F.lit(seed), F.col(id_col))).mapInArrow(lean(run), schema)
