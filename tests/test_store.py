import datetime as dt

from pyspark.sql import functions as F

from lectern.operators import buckets as B
from lectern.operators import store as S


def _raw(spark, rows):
    return spark.createDataFrame(rows, "article_id long, url string, title string, author string, "
                                       "published_at string, text string, tags array<string>")


def _chunks(spark):
    return spark.createDataFrame([(1, 0, "alpha", [1.0, 0.0]), (2, 0, "beta", [0.0, 1.0])],
                                 "article_id long, position int, text string, embedding array<float>")


def test_load_twice_is_idempotent(spark):
    raw = _raw(spark, [(1, " https://x/library/a ", "A", None, "2020-01-02", "body a", ["t1", " t2 "]),
                       (2, "https://x/library/b", "B", "me", "bad", "body b", ["t2", "t3", ""])])
    asg = spark.createDataFrame([(1, 0, 0.9, [(1, 0.1)]), (7, 1, 0.5, [])],
                                "article_id long, topic_id int, topic_prob double, "
                                "secondary_topics array<struct<topic_id:int,probability:double>>")
    st1, summ = S.load(S.empty_store(spark), raw, _chunks(spark), asg, load_ts=dt.datetime(2024, 1, 1))
    st2, _ = S.load(st1, raw, _chunks(spark), asg, load_ts=dt.datetime(2024, 2, 1))
    counts = {k: v.count() for k, v in st2.items()}
    assert counts == {"articles": 2, "chunks": 2, "tags": 3, "topics": 2, "article_tags": 4, "tone": 0}
    s = summ.collect()[0]
    assert (s.articles, s.tags, s.chunks, s.topic_articles) == (2, 4, 2, 1)
    a = {r.url: r for r in st2["articles"].collect()}
    assert a["https://x/library/a"].published_at == dt.date(2020, 1, 2)
    assert a["https://x/library/b"].published_at is None
    assert a["https://x/library/a"].created_at == dt.datetime(2024, 1, 1)
    assert a["https://x/library/a"].topic_id == 0
    from lectern.operators.quality import star_violations
    assert star_violations(st2).count() == 0


def test_upsert_keeps_vanished_chunks(spark):
    old = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "article_id long, position int, text string")
    new = spark.createDataFrame([(1, 0, "A")], "article_id long, position int, text string")
    smap = spark.createDataFrame([(1, 1)], "source_id long, id long")
    got = sorted((r.position, r.text) for r in S.upsert_chunks(old, new, smap).collect())
    assert got == [(0, "A"), (1, "b")]
    got = sorted((r.position, r.text) for r in S.upsert_chunks(old, new, smap, delete_missing=True).collect())
    assert got == [(0, "A")]


def test_write_and_read_store(spark, tmp_path):
    st, _ = S.load(S.empty_store(spark), _raw(spark, [(1, "u", "t", "a", "", "x", [])]))
    B.write_store(st, str(tmp_path / "store"))
    back = B.read_store(spark, str(tmp_path / "store"))
    assert back["articles"].select(F.col("url")).collect()[0].url == "u"
