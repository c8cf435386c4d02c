"""Phrases, block search, list-major probing and likelihood outliers."""

import re

import numpy as np
from pyspark.sql import functions as F

from lectern.operators import shortlist as SL
from lectern.operators import textindex as TI
from lectern.operators.topics import STOP_WORDS, fit_topics, log_densities, low_density, reduce_vectors

TEXTS = {1: "the red fox saw the red fox", 2: "red the fox", 3: "fox red", 4: "a red fox and a blue fox", 5: "", 6: None,
         7: "the red " * 50 + "fox", 8: "blue fox red fox"}


def post_of(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "article_id long, text string").repartition(3)
    return TI.postings(docs)


def plain_phrase(query):
    ask = re.findall(r"\w+", query.lower())
    out = {}
    for i, text in TEXTS.items():
        words = re.findall(r"\w+", (text or "").lower())
        hits = [s for s in range(len(words)) if any(a not in STOP_WORDS for a in ask) and all(
            a in STOP_WORDS or s + o < len(words) and words[s + o] == a for o, a in enumerate(ask))]
        if hits:
            out[i] = (len(hits), hits[0] + 1)
    return out


def test_phrases(spark):
    asked = {1: "red fox", 2: "the red fox", 3: "red the fox", 4: "fox", 5: "the and", 6: "", 7: "green fox", 8: "fox red fox", 9: "RED, fox!", 10: None}
    q = spark.createDataFrame(list(asked.items()), "query_id long, query string")
    got = {}
    for r in TI.phrase_search(q, post_of(spark), top=100).collect():
        got.setdefault(r.query_id, {})[r.article_id] = (r.occurrences, r.first_position)
    assert got == {i: p for i, t in asked.items() if (p := plain_phrase(t or ""))}
    top = TI.phrase_search(q.where("query_id = 4"), post_of(spark), top=2).orderBy("rank").collect()
    assert [(r.article_id, r.occurrences) for r in top] == [(1, 2), (4, 2)]


def test_block_search_equals_plain_search(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(40)]
    weights = 1 / np.arange(1, 41)
    docs = [(int(i), " ".join(rng.choice(vocabulary, size=rng.integers(1, 40), p=weights / weights.sum()))) for i in range(300)]
    post = TI.postings(spark.createDataFrame(docs, "article_id long, text string")).cache()
    q = spark.createDataFrame([(i, " ".join(rng.choice(vocabulary, size=3))) for i in range(12)] + [(50, "nothing"), (51, "")],
                              "query_id long, query string")
    want = sorted(map(tuple, TI.search(q, post, n_docs=300, top=5).collect()))
    assert sorted(map(tuple, TI.search_blocks(q, TI.block_postings(post, size=16), 300, top=5).collect())) == want
    monkeypatch.setattr(TI, "FIRST_BLOCKS", 1)
    assert sorted(map(tuple, TI.search_blocks(q, TI.block_postings(post, size=4), 300, top=5).collect())) == want


def _corpus(spark, n=600, d=8):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, d))
    v = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, d)) * 0.15
    rows = [(i, 0, [float(x) for x in r]) for i, r in enumerate(v)] + [(n + i, 0, [float(x) for x in v[0]]) for i in range(30)]
    corpus = spark.createDataFrame(rows, "article_id long, position int, embedding array<double>")
    queries = spark.createDataFrame([(i, [float(x) for x in v[i * 7] + 0.05]) for i in range(20)], "query_id long, embedding array<double>")
    return corpus, queries


def test_probing_is_exact_with_all_lists_and_recalls_with_few(spark, monkeypatch):
    corpus, queries = _corpus(spark)
    cents, folder = SL.write_lists(corpus, 12)
    indexed = spark.read.parquet(folder)
    exact = SL.shortlist(queries, corpus, k=10)
    want = sorted(map(tuple, exact.select("query_id", "article_id", "position", "score", "rank").collect()))
    for piece in (4096, 40):                                  # with small pieces the hot list is cut
        monkeypatch.setattr(SL, "LIST_PIECE", piece)
        every = SL.ivf_shortlist(queries, indexed, cents, k=10, probes=12)
        assert sorted(map(tuple, every.select("query_id", "article_id", "position", "score", "rank").collect())) == want
    for probes, least in ((3, 0.9), (6, 0.97)):
        some = SL.ivf_shortlist(queries, indexed, cents, k=10, probes=probes)
        found = some.join(exact, ["query_id", "article_id", "position"]).count()
        assert found / len(want) >= least


def test_least_likely_vectors_are_outliers(spark):
    rng = np.random.default_rng(8)
    centres = np.array([[0.0, 0, 0], [9, 0, 0], [0, 9, 0]])
    v = np.concatenate([centres[rng.integers(0, 3, 392)] + rng.normal(size=(392, 3)), rng.uniform(-9, 9, (8, 3)) + [0, 0, 60]])
    rows = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "article_id long, embedding array<double>")
    models, assignments, _ = fit_topics(rows, n_topics=4, min_cluster_size=1, pca_k=3, outlier_share=0.02)
    _, reduced = reduce_vectors(rows, 3)
    got = {r.article_id: r.log_density for r in log_densities(models["gmm"], reduced).collect()}
    x = np.array([r.reduced.toArray() for r in reduced.orderBy("article_id").collect()])
    gm, want = models["gmm"], np.zeros(400)
    for w, g in zip(gm.weights, gm.gaussiansDF.collect()):
        m, c = g["mean"].toArray(), g["cov"].toArray()
        d = x - m
        want += w * np.exp(-0.5 * (d @ np.linalg.inv(c) * d).sum(axis=1)) / np.sqrt((2 * np.pi) ** 3 * np.linalg.det(c))
    assert np.allclose([got[i] for i in range(400)], np.log(want), atol=1e-4)
    topic = {r.article_id: r.topic_id for r in assignments.collect()}
    assert sum(t == -1 for t in topic.values()) <= 9 and len(topic) == 400
    scores = spark.createDataFrame([(i, float(i)) for i in range(1000)], "article_id long, log_density double")
    low = low_density(scores, 0.02).where("outlier").agg(F.count(F.lit(1)), F.max("log_density")).first()
    assert 15 <= low[0] <= 25 and low[1] < 30
    assert low_density(scores, 0.0).where("outlier").count() == 0


def test_planted_outliers(spark):
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(size=(490, 4)), rng.normal(size=(10, 4)) * 0.1 + np.sign(rng.normal(size=(10, 4))) * 7])
    rows = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "article_id long, embedding array<double>")
    _, assignments, _ = fit_topics(rows, n_topics=2, min_cluster_size=5, pca_k=4, outlier_share=0.02)
    out = {r.article_id for r in assignments.collect() if r.topic_id == -1}
    assert len(out & set(range(490, 500))) >= 8 and len(out) <= 15
