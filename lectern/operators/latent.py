"""A trained encoder (M1): the leading directions of the tf-idf matrix.

Rows are texts, columns hash buckets of words, weights (1 + ln count) * idf, rows
of length 1. The matrix A is never formed: each pass over the hashed texts
gives A'(A Q) for an orthonormal Q of a fixed size, so a randomised start and
some power iterations reach the leading right singular vectors, and the last
pass their values (Rayleigh-Ritz). A text's vector is its row times those
vectors, scaled to length 1.

A task holds one sum of buckets x directions (9 MB by default) and passes it on
once, in parts that are added in order of the tasks, so the same layout gives
the same model; the driver holds the same size. Nothing grows with the corpus
but the number of tasks.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.config import EMBEDDING_DIMENSION
from lectern.functions.tokens import py_bucket, py_tokens
from lectern.session import discard, written

FEATURES = 1 << 13          # hash buckets
DIRECTIONS = 128
OVERSAMPLE = 16             # directions beyond those that are kept, which speeds the iterations up
ITERATIONS = 4
_PARTS = 32                 # a sum travels in so many parts
_ENTRIES = 1 << 14          # weights multiplied at once, at most,
_ROWS = 16                  # and rows: their matrix over the buckets that they have stays in a core's cache
_CHARS = 1 << 20            # characters of text hashed at once, or one longer text


class _Known(dict):
    """Buckets of words, each worked out once."""

    def __init__(self, features: int):
        self.features = features

    def __missing__(self, word: str) -> int:
        own = self[word] = py_bucket(word, self.features)
        return own


class _Hashed:
    """Words of texts as counted buckets."""

    def __init__(self, features: int):
        self.features = features
        self._known = _Known(features)

    def _some(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self._known) > 500_000:
            self._known.clear()
        n = np.fromiter(map(len, words), np.int64, len(words))
        own = np.fromiter(map(self._known.__getitem__, chain.from_iterable(words)), np.int64, int(n.sum()))
        key, counts = np.unique(np.repeat(np.arange(len(words)) * self.features, n) + own, return_counts=True)
        first = np.searchsorted(key, np.arange(1, len(words) + 1) * self.features)
        return first, (key % self.features).astype(np.int32), counts.astype(np.int32)

    def rows(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where each text begins, buckets in order, counts)."""
        first, ids, counts = [np.zeros(1, dtype=np.int64)], [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)]
        words, chars = [], 0
        for k, text in enumerate(texts, 1):
            words.append(py_tokens(text))
            chars += len(text or "")
            if chars >= _CHARS or k == len(texts):
                ends, bucket, n = self._some(words)
                first.append(first[-1][-1] + ends)
                ids.append(bucket)
                counts.append(n)
                words, chars = [], 0
        return np.concatenate(first), np.concatenate(ids), np.concatenate(counts)


def _weights(first: np.ndarray, ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of each entry, its weight); rows have length 1."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    w = (1 + np.log(counts)) * idf[ids]
    return row, w / np.sqrt(np.bincount(row, w * w, minlength=len(first) - 1))[row]


def _cuts(first: np.ndarray):
    """(from, to) of at most _ROWS neighbouring rows with at most _ENTRIES weights, or one row of more."""
    lo = 0
    while lo < len(first) - 1:
        hi = int(np.searchsorted(first, first[lo] + _ENTRIES, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + _ROWS, len(first) - 1)
        yield lo, hi
        lo = hi


def _blocks(first: np.ndarray, ids: np.ndarray, row: np.ndarray, w: np.ndarray, features: int):
    """(from, to, buckets, weights) of neighbouring rows that have words: the buckets
    that they have, ascending, and their rows over those, as a full matrix."""
    has, place = np.zeros(features, dtype=bool), np.zeros(features, dtype=np.int64)
    for lo, hi in _cuts(first):
        a, b = first[lo], first[hi]
        if a == b:
            continue
        has[ids[a:b]] = True
        buckets = np.flatnonzero(has)
        has[buckets] = False
        place[buckets] = np.arange(len(buckets))
        full = np.zeros((hi - lo, len(buckets)))
        full[row[a:b] - lo, place[ids[a:b]]] = w[a:b]
        yield lo, hi, buckets, full


class LatentEncoder:
    """``encode`` of texts by a fitted model; ``width`` numbers each, zeros behind the directions."""

    def __init__(self, idf: np.ndarray, basis: np.ndarray, width: int):
        if basis.shape[1] > width:
            raise ValueError(f"{basis.shape[1]} directions do not fit {width} numbers")
        self.idf, self.basis, self.width, self._words = idf, basis, width, _Hashed(len(idf))

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.width), dtype=np.float32)
        first, ids, counts = self._words.rows(texts)
        row, w = _weights(first, ids, counts, self.idf)
        for lo, hi, buckets, full in _blocks(first, ids, row, w, len(self.idf)):
            v = full @ self.basis[buckets]
            size = np.sqrt((v * v).sum(axis=1, keepdims=True))
            out[lo:hi, :v.shape[1]] = v / np.where(size > 0, size, 1.0)
        return out


@dataclass(frozen=True)
class LatentModel:
    idf: np.ndarray         # of each bucket
    basis: np.ndarray       # buckets x directions, orthonormal
    values: np.ndarray      # singular values, descending

    def encoder(self, spark, width: int = EMBEDDING_DIMENSION):
        """A factory for ``encode_column``; the model reaches the workers as a broadcast."""
        sent = spark.sparkContext.broadcast((self.idf, self.basis))
        return lambda: LatentEncoder(*sent.value, width)


def _hash_texts(text: str, features: int):
    def run(batches):
        words = _Hashed(features)
        for batch in batches:
            first, ids, counts = words.rows(batch.column(text).to_pylist())
            off = pa.array(first.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(off, pa.array(ids)),
                                              pa.ListArray.from_arrays(off, pa.array(counts))], ["ids", "counts"])
    return run


def _gram_times(sent):
    """A'(A Q) of a task's rows, in parts."""
    def run(batches):
        idf, q = sent.value
        total, any_rows = np.zeros(q.shape), False
        for batch in batches:
            any_rows = True
            lists = batch.column("ids")
            first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))])
            ids, counts = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            row, w = _weights(first, ids, counts, idf)
            for _, _, buckets, full in _blocks(first, ids, row, w, len(idf)):
                total[buckets] += full.T @ (full @ q[buckets])
        if any_rows:
            task = TaskContext.get().partitionId()
            parts = np.array_split(total, _PARTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(_PARTS), pa.int32()), pa.array([task] * _PARTS, pa.int32()),
                 pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "task", "sums"])
    return run


def _add(batches):
    """Parts summed in the order that they come in."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("sums")):
            own = np.frombuffer(raw.as_py())
            total[part] = total[part] + own if part in total else own
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
                                     ["part", "sums"])


def fit_latent(docs: DataFrame, text: str = "text", directions: int = DIRECTIONS, features: int = FEATURES,
               iterations: int = ITERATIONS, seed: int = 0) -> LatentModel:
    """The model of all texts, in ``iterations`` + 1 passes over their hashed words.

    Null and wordless texts are rows of zeros. Directions that the texts do not span
    are zeros, as is the whole model of an empty table."""
    spark = docs.sparkSession
    scratch: list[str] = []
    hashed = written(docs.select(text).mapInArrow(_hash_texts(text, features), "ids array<int>, counts array<int>"),
                     "hashed_words", scratch)
    df = np.zeros(features)
    for bucket, n in hashed.select(F.explode("ids").alias("b")).groupBy("b").count().collect():
        df[bucket] = n
    idf = np.log((1 + hashed.count()) / (1 + df)) + 1

    def gram_times(q: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast((idf, q))
        parts = hashed.mapInArrow(_gram_times(sent), "part int, task int, sums binary")
        # written, so that what all tasks passed on goes before the next pass
        added: list[str] = []
        summed = written(parts.repartition("part").sortWithinPartitions("part", "task").mapInArrow(_add, "part int, sums binary"),
                         "sums", added).collect()
        sent.destroy()
        discard(spark, added)
        by = {r["part"]: np.frombuffer(bytes(r["sums"])) for r in summed}
        return np.concatenate([by[p] for p in sorted(by)]).reshape(q.shape) if by else np.zeros(q.shape)

    wide = min(directions + OVERSAMPLE, features)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((features, wide)))[0]
    for _ in range(iterations):
        q = np.linalg.qr(gram_times(q))[0]
    small = q.T @ gram_times(q)
    discard(spark, scratch)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values, kind="stable")[:directions]
    values = np.maximum(values[best], 0.0)
    basis = q @ turn[:, best]
    basis = basis * np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])       # a sign that does not depend on the start
    return LatentModel(idf, np.where(values > 1e-10 * max(values.max(), 1e-300), basis, 0.0), np.sqrt(values))
