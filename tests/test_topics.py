import pytest
from pyspark.sql import functions as F

from lectern.operators.topics import ngrams, secondary_topics
from lectern.plans.star import list_topics


def _probs(spark, rows):
    return spark.createDataFrame(rows, "article_id long, topic_id int, probability double")


def test_secondary_topics_primary_present(spark):
    probs = _probs(spark, [(1, 0, 0.1), (1, 1, 0.7), (1, 2, 0.2)])
    prim = spark.createDataFrame([(1, 1)], "article_id long, topic_id int")
    r = secondary_topics(prim, probs).collect()[0]
    assert r.topic_prob == pytest.approx(0.7)
    assert [(s.topic_id, s.probability) for s in r.secondary_topics] == [(2, 0.2), (0, 0.1)]


def test_secondary_topics_outlier(spark):
    probs = _probs(spark, [(1, 0, 0.1), (1, 1, 0.7), (1, 2, 0.2)])
    prim = spark.createDataFrame([(1, -1)], "article_id long, topic_id int")
    r = secondary_topics(prim, probs).collect()[0]
    assert r.topic_prob == 0.0
    assert r.secondary_topics[0].topic_id == 1


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["x"],)], "t array<string>")
    got = [r.g for r in df.select(ngrams(F.col("t")).alias("g")).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["x"]]


def test_list_topics_order(spark):
    t = spark.createDataFrame([(-1, 900), (0, 120), (1, 300), (2, None)], "id int, size int")
    assert [r.id for r in list_topics(t).collect()] == [1, 0, 2]
    assert [r.id for r in list_topics(t, include_outliers=True).collect()] == [-1, 1, 0, 2]
    with pytest.raises(ValueError):
        list_topics(t, limit=0)


def test_centroid_scores_grouped_equals_single(spark):
    from lectern.operators.topics import centroid_scores
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.6, 0.8]), (3, [0.0, 1.0])],
                              "article_id long, embedding array<float>")
    c = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.7, 0.7])],
                              "topic_id int, embedding array<double>")
    one = sorted(map(tuple, centroid_scores(v, c).collect()))
    many = sorted(map(tuple, centroid_scores(v, c, limit_bytes=16).collect()))
    assert one == many and len(one) == 9
