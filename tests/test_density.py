"""Density clusters and components against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators.components import components
from lectern.operators.density import density_clusters


def plain(ids, v, eps, min_points, min_size=1):
    d = sum((v[:, k, None] - v[None, :, k]) ** 2 for k in range(v.shape[1]))
    near = d <= eps * eps
    core = near.sum(axis=1) >= min_points
    label = np.full(len(ids), -1)
    for i in np.argsort(ids):
        if not core[i] or label[i] >= 0:
            continue
        stack = [i]
        label[i] = ids[i]
        while stack:
            x = stack.pop()
            for y in np.flatnonzero(near[x] & core):
                if label[y] < 0:
                    label[y] = ids[i]
                    stack.append(y)
    for i in np.flatnonzero(~core):
        reach = [(d[i, j], ids[j], label[j]) for j in np.flatnonzero(near[i] & core)]
        if reach:
            label[i] = min(reach)[2]
    size = {c: int((label == c).sum()) for c in set(label.tolist()) - {-1}}
    order = sorted((c for c in size if size[c] >= min_size), key=lambda c: (-size[c], c))
    return {int(i): (order.index(c) if c in order else -1, bool(k)) for i, c, k in zip(ids, label, core)}


def vectors(spark, ids, v):
    return spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(ids, v)],
                                 "article_id long, embedding array<double>").repartition(3)


@pytest.mark.parametrize("piece", [1024, 60])
def test_two_thousand_vectors(spark, piece):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(7, 5)) * 3
    v = np.concatenate([centres[rng.integers(0, 7, 1500)] + rng.normal(size=(1500, 5)) * 0.25,
                        rng.uniform(-8, 8, (460, 5)), np.repeat(centres[:1], 40, axis=0)])       # noise, and equal points
    ids = rng.permutation(10_000)[:2000]
    got = density_clusters(vectors(spark, ids, v), 0.6, 8, min_cluster_size=10, piece=piece)
    plan = got._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    want = plain(ids, v, 0.6, 8, 10)
    assert {r.article_id: (r.topic_id, r.core) for r in got.collect()} == want
    assert len({t for t, _ in want.values()}) > 4 and any(t == -1 for t, _ in want.values())


def test_few_vectors(spark):
    v = np.array([[0.0], [1.0], [2.0], [2.9], [10.0], [10.5], [50.0]])
    ids = np.arange(7)
    assert {r.article_id: (r.topic_id, r.core) for r in density_clusters(vectors(spark, ids, v), 1.0, 3).collect()} == plain(ids, v, 1.0, 3)
    one = density_clusters(vectors(spark, ids[:1], v[:1]), 1.0, 1).collect()
    assert [(r.article_id, r.topic_id, r.core) for r in one] == [(0, 0, True)]
    assert density_clusters(vectors(spark, ids, v).limit(0), 1.0, 3).count() == 0
    holes = vectors(spark, ids, v).unionByName(spark.createDataFrame([(None, [1.0]), (99, None)], "article_id long, embedding array<double>"))
    assert density_clusters(holes, 1.0, 3).count() == 7


def test_components(spark):
    rng = np.random.default_rng(9)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000, i) for i in range(400, 700)]
    links += [(i, i + 1) for i in range(2000, 2100)] + [(5000, 5000), (None, 3), (7, None)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {}
    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and b is not None:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
