import numpy as np

from lectern.operators import shortlist as SL


def test_lists_are_k_means_over_all_vectors(spark):
    """Clear clusters, copies, a vector without length and none at all; files are of bounded size."""
    rng = np.random.default_rng(5)
    centres = np.eye(6)
    v = centres[rng.integers(0, 6, 500)] + rng.normal(size=(500, 6)) * 0.05
    rows = [(i, 0, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(1000 + i, 0, [float(x) for x in v[0]]) for i in range(300)] + [(2000, 0, [0.0] * 6), (2001, 0, None)]
    corpus = spark.createDataFrame(rows, "article_id long, position int, embedding array<double>")
    cents, assigned = SL.build_lists(corpus, 40)
    c = {r.list_id: np.array(r.embedding) for r in cents.collect()}
    assert len(c) == 40 and all(abs(np.linalg.norm(x) - 1) < 1e-6 for x in c.values())
    got = {r.article_id: r for r in assigned.collect()}
    assert sorted(got) == [*range(500), *range(1000, 1300)]
    mat = np.array([c[i] for i in range(40)])
    for r in got.values():
        x = np.array(r.embedding) / np.linalg.norm(r.embedding)
        assert (mat @ x)[r.list_id] >= (mat @ x).max() - 1e-6
    fewer, _ = SL.build_lists(corpus.where("article_id >= 1000"), 40)
    assert fewer.count() == 1
    none, empty = SL.build_lists(corpus.where("article_id < 0"), 40)
    assert none.count() == 0 and empty.count() == 0


def test_a_hot_list_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(SL, "LIST_FILE_ROWS", 50)
    rows = [(i, 0, [1.0, 0.0]) for i in range(1000)] + [(1000 + i, 0, [0.0, 1.0]) for i in range(5)]
    corpus = spark.createDataFrame(rows, "article_id long, position int, embedding array<double>")
    _, folder = SL.write_lists(corpus, 2)
    from pyspark.sql import functions as F
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1005 and max(sizes) <= 200
