"""Vector encoding (M1, M2) and the validation of its output (V5).

An encoder is any object with ``encode(list[str]) -> ndarray[n, dim]``. It
is built by a zero-argument factory once per Python worker and fed Arrow
batches, so a user can plug in a neural sentence encoder unchanged.

The default is a hashed bag of words: each token adds one to bucket
``md5(token)[:7] % dim`` and the count vector is L2-normalised and stored as
float32. It is a lexical stand-in, not an equal of a neural model, but it
needs no download and the SQL oracle can compute it too.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.config import EMBEDDING_DIMENSION
from lectern.functions.arrow import lean
from lectern.functions.models import model_key, worker_model
from lectern.functions.tokens import py_bucket, py_tokens


class HashedBagOfWords:
    """Deterministic lexical encoder (the default)."""

    def __init__(self, dim: int = EMBEDDING_DIMENSION):
        self.dim = dim
        self._cache: dict[str, int] = {}

    def _bucket(self, tok: str) -> int:
        b = self._cache.get(tok)
        if b is None:
            if len(self._cache) > 500_000:
                self._cache.clear()
            b = self._cache[tok] = py_bucket(tok, self.dim)
        return b

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for i, text in enumerate(texts):
            toks = py_tokens(text)
            if not toks:
                continue
            counts = np.bincount([self._bucket(t) for t in toks], minlength=self.dim)
            norm = np.sqrt(float(np.dot(counts, counts)))
            out[i] = (counts / norm).astype(np.float32)
        return out


def hashed_encoder(dim: int = EMBEDDING_DIMENSION) -> Callable[[], HashedBagOfWords]:
    return functools.partial(HashedBagOfWords, dim)


def check_vectors(vectors: np.ndarray, n: int, dim: int) -> None:
    """V5: one vector of ``dim`` finite numbers per text; the error names the first
    text without one and what is wrong with it."""
    if vectors.ndim != 2 or len(vectors) != n:
        raise ValueError(f"{n} texts gave vectors of shape {vectors.shape}")
    if vectors.shape[1] != dim:
        raise ValueError(f"vectors have {vectors.shape[1]} numbers, not {dim}")
    bad = np.argwhere(~np.isfinite(vectors))
    if len(bad):
        row, column = bad[0]
        raise ValueError(f"the vector of text {row} has {vectors[row, column]} at place {column}")


def _encode_batches(factory, dim: int, text_col: str, out_col: str):
    key = model_key(factory)

    def run(batches):
        model = worker_model(key, factory)
        for b in batches:
            texts = ["" if t is None else t for t in b.column(text_col).to_pylist()]
            vectors = np.ascontiguousarray(np.asarray(model.encode(texts), dtype=np.float32))
            check_vectors(vectors, len(texts), dim)
            offsets = pa.array(np.arange(0, (len(texts) + 1) * dim, dim, dtype=np.int32))
            values = pa.array(vectors.reshape(-1), type=pa.float32())
            yield b.append_column(out_col, pa.ListArray.from_arrays(offsets, values))
    return run


def encode_column(df: DataFrame, text_col: str, out_col: str = "embedding",
                  encoder_factory=None, dim: int = EMBEDDING_DIMENSION) -> DataFrame:
    """Append ``out_col`` (array<float>, ``dim`` long) encoded from ``text_col``.

    Runs as ``mapInArrow``: one encoder call per Arrow batch and the vectors
    handed back as one flat float32 buffer, no per-row conversion."""
    factory = encoder_factory or hashed_encoder(dim)
    schema = T.StructType(df.schema.fields + [
        T.StructField(out_col, T.ArrayType(T.FloatType(), containsNull=False), True)])
    return df.mapInArrow(lean(_encode_batches(factory, dim, text_col, out_col)), schema)


def encode_chunks(chunks: DataFrame, encoder_factory=None,
                  dim: int = EMBEDDING_DIMENSION) -> DataFrame:
    """M1: chunks + embedding (float32, ``dim`` long)."""
    return encode_column(chunks, "chunk_text", "embedding", encoder_factory, dim)


def encode_queries(queries: DataFrame, encoder_factory=None,
                   dim: int = EMBEDDING_DIMENSION, text_col: str = "query") -> DataFrame:
    """M2: strip, drop blank queries, encode."""
    q = queries.withColumn(text_col, F.trim(F.regexp_replace(F.col(text_col), r"^\s+|\s+$", "")))
    q = q.where(F.col(text_col) != "")
    return encode_column(q, text_col, "embedding", encoder_factory, dim)
