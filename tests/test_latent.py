import math
import random
from collections import Counter

import numpy as np
import pytest

from lectern.functions.tokens import py_bucket, py_tokens
from lectern.operators import latent as L
from lectern.operators.encode import encode_column

FEATURES = 64


def some_texts():
    rng = random.Random(3)
    topics = [[f"{t}{i}" for i in range(6 + 3 * k)] for k, t in enumerate("abcd")]
    texts = [" ".join(rng.choice(rng.choice([t, t, t, topics[0]])) for _ in range(rng.randint(1, 25))) for t in topics for _ in range(30)]
    return [*texts, None, "", "...", texts[0], "a1 " * 500]


def plain_matrix(texts):
    counts = [Counter(py_bucket(t, FEATURES) for t in py_tokens(x)) for x in texts]
    df = Counter(b for c in counts for b in c)
    out = np.zeros((len(texts), FEATURES))
    for i, c in enumerate(counts):
        for b, n in c.items():
            out[i, b] = (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[b])) + 1)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


@pytest.mark.parametrize("entries", [1 << 14, 20])
def test_directions_are_the_singular_vectors(spark, monkeypatch, entries):
    monkeypatch.setattr(L, "_ENTRIES", entries)
    texts = some_texts()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(5, "id")
    model = L.fit_latent(docs, directions=5, features=FEATURES, iterations=10, seed=1)
    a = plain_matrix(texts)
    _, values, v = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(model.values, values[:5], rtol=1e-6)
    assert np.abs(model.basis @ model.basis.T - v[:5].T @ v[:5]).max() < 1e-4
    got = {r.id: np.array(r.embedding) for r in encode_column(docs, "text", "embedding", model.encoder(spark, 8), 8).collect()}
    want = a @ model.basis
    want = want / np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-300)
    for i in range(len(texts)):
        assert np.abs(got[i][:5] - want[i]).max() < 1e-5 and not got[i][5:].any()
    again = L.fit_latent(docs, directions=5, features=FEATURES, iterations=10, seed=1)
    assert (again.basis == model.basis).all()


def test_model_of_little(spark):
    none = L.fit_latent(spark.createDataFrame([], "text string"), directions=3, features=16)
    assert not none.basis.any() and not L.LatentEncoder(none.idf, none.basis, 4).encode(["a", ""]).any()
    one = L.fit_latent(spark.createDataFrame([("red fox",), (None,)], "text string"), directions=3, features=16)
    assert (np.abs(one.basis).sum(axis=0) > 0).tolist() == [True, False, False]
    with pytest.raises(ValueError):
        L.LatentEncoder(one.idf, one.basis, 2)


def many_texts():
    rng = random.Random(5)
    return [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([0, 1, 60, 90]))) for _ in range(700)] + [None, "only " * 40_000]


def test_products_stay_small(monkeypatch):
    """A pass multiplies a few rows at a time: what it holds beside the sum does not grow with the weights."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    texts, rng = many_texts(), np.random.default_rng(1)
    q = rng.standard_normal((2048, 100))
    a = np.zeros((len(texts), 2048))
    for i, t in enumerate(texts):
        for b, n in Counter(py_bucket(w, 2048) for w in py_tokens(t)).items():
            a[i, b] = 1 + math.log(n)
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    hashed = list(L._hash_texts("text", 2048)(iter([pa.record_batch({"text": pa.array(texts, pa.string())})])))
    monkeypatch.setattr(L, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 7)))
    tracemalloc.start()
    [sums] = L._gram_times(SimpleNamespace(value=(np.ones(2048), q)))(iter(hashed))
    peak = tracemalloc.get_traced_memory()[1]
    made = L.LatentEncoder(np.ones(2048), q, 100).encode(texts)
    encoded = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = np.concatenate([np.frombuffer(x.as_py()) for x in sums.column("sums")]).reshape(q.shape)
    assert np.allclose(got, a.T @ (a @ q), rtol=1e-9, atol=1e-9) and set(sums.column("task").to_pylist()) == {7}
    want = a @ q
    assert np.allclose(made, want / np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-300), atol=1e-6)
    assert peak < 12e6 and encoded < 12e6


def test_hashing_goes_by_slices(monkeypatch):
    texts = many_texts()
    whole = L._Hashed(64).rows(texts)
    monkeypatch.setattr(L, "_CHARS", 500)
    cut = L._Hashed(64).rows(texts)
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(whole, cut))
    for i, t in enumerate(texts):
        own = Counter(py_bucket(w, 64) for w in py_tokens(t))
        at = slice(whole[0][i], whole[0][i + 1])
        assert dict(zip(whole[1][at].tolist(), whole[2][at].tolist())) == own and sorted(own) == whole[1][at].tolist()
    assert [len(x) for x in L._Hashed(64).rows([])] == [1, 0, 0]


def test_a_fit_leaves_nothing_on_disk(spark):
    import glob
    import os

    from lectern.session import ensure_checkpoint_dir
    tables = f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/tables/*"
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def left():
        return set(glob.glob(tables)) | {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data") if os.path.getsize(f) > 10_000}
    docs, before = spark.createDataFrame([(t,) for t in some_texts()], "text string").repartition(5), left()
    model = L.fit_latent(docs, directions=20, features=1024, iterations=2)
    assert model.basis.any() and not {f for f in left() - before if os.path.isdir(f)}
    assert len(left() - before) <= 1              # the count of documents by bucket, at most
