"""The bucketed store: what a load rewrites, views by deltas, versions, catalog."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lectern.config import TONE_LABELS
from lectern.operators import buckets as B
from lectern.operators import store as S
from lectern.operators.quality import star_violations
from lectern.streaming.ingest import RAW_SCHEMA

ASG = "article_id long, topic_id int, topic_prob double, secondary_topics array<struct<topic_id:int,probability:double>>"
TONE = "article_id long, " + ", ".join(f"{lb} double" for lb in TONE_LABELS)


def raw_rows(ids, mark=""):
    return [(i, f"https://x/{i}", f"t{i}", None, "2024-01-02", f"text {i} {mark}", [f"tag{i % 5}", f"{mark}tag"]) for i in ids]


def load(spark, root, ids, mark="", topic=lambda i: i % 3, **options):
    ids = list(ids)
    return B.merge_load(
        spark, root, spark.createDataFrame(raw_rows(ids, mark), RAW_SCHEMA),
        chunk_vectors=spark.createDataFrame([(i, k, f"chunk {i} {k} {mark}", [float(i), 1.0]) for i in ids for k in (0, 1)],
                                            "article_id long, position int, text string, embedding array<float>"),
        assignments=spark.createDataFrame([(i, topic(i), 0.5, []) for i in ids], ASG),
        tone=spark.createDataFrame([(i, (i % 10) / 10, 0.123457, 0.3, 1 / (i + 1)) for i in ids], TONE), **options)


def files(root, name):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{root}/{name}") for f in fs if f.endswith(".parquet")}


def shown(store, name):
    return sorted(map(repr, store[name].collect()))


def recomputed(store):
    """The views from the base tables."""
    a = store["articles"].join(store["tone"].withColumnRenamed("article_id", "id"), "id", "left")
    topics = a.where("topic_id is not null").groupBy("topic_id").agg(
        F.count(F.lit(1)).alias("n_articles"), F.count(TONE_LABELS[0]).alias("n_toned"),
        *[F.coalesce(F.sum(F.round(lb, 6).cast("decimal(38,6)")), F.lit(0)).cast("decimal(38,6)").alias(f"sum_{lb}") for lb in TONE_LABELS])
    tags = store["article_tags"].groupBy("tag_id").agg(F.count(F.lit(1)).alias("n_articles"))
    return sorted(map(repr, topics.collect())), sorted(map(repr, tags.collect()))


def check_views(store):
    topics, tags = recomputed(store)
    assert shown(store, "topic_stats") == topics and shown(store, "tag_counts") == tags


def test_a_small_load_rewrites_only_its_buckets(spark, tmp_path):
    root = str(tmp_path / "store")
    load(spark, root, range(400), buckets=64)
    before = {n: files(root, n) for n in B.KEYS}
    old = B.read_state(spark, root)
    load(spark, root, [5, 17, 333, 1000], mark="new")                # 1 %: three changed rows and a new one
    state, after = B.read_state(spark, root), {n: files(root, n) for n in B.KEYS}
    assert all(before[n] <= after[n] for n in B.KEYS)                # nothing is overwritten
    for name in ("articles", "chunks", "tone", "article_tags"):
        moved = [b for b, v in state["tables"][name].items() if v != old["tables"][name].get(b)]
        fresh = {f.split("bucket=")[1].split("/")[0] for f in after[name] - before[name]}
        assert set(moved) == fresh and 1 <= len(moved) <= 4
    store = B.read_store(spark, root)
    assert store["articles"].count() == 401 and store["articles"].agg(F.max("id")).first()[0] == 401
    assert store["articles"].where("url = 'https://x/17'").first().body == "text 17 new"
    assert star_violations({n: store[n] for n in S.empty_store(spark)}).count() == 0
    check_views(store)


def test_views_after_three_batches_and_a_replay(spark, tmp_path):
    root = str(tmp_path / "store")
    load(spark, root, range(40), buckets=8)
    load(spark, root, range(30, 60), topic=lambda i: 9)              # ten articles move to another topic
    load(spark, root, [1, 2, 3, 61], mark="z", topic=lambda i: -1)
    store = B.read_store(spark, root)
    check_views(store)
    before = {n: shown(store, n) for n in B.KEYS}
    load(spark, root, [1, 2, 3, 61], mark="z", topic=lambda i: -1)
    again = B.read_store(spark, root)
    assert before == {n: shown(again, n) for n in B.KEYS}
    whole = str(tmp_path / "whole")                                  # written as a whole: the same views
    B.write_store({n: again[n] for n in S.empty_store(spark)}, whole, buckets=4)
    check_views(B.read_store(spark, whole))
    means = {r.topic_id: r for r in B.topic_tone_means(again).collect()}
    assert means[9].n_articles == 30 and abs(means[9].mean_militant - 0.123457) < 1e-9
    assert {r.name: r.n_articles for r in B.tag_frequency(again).collect()}["ztag"] == 4


def test_merge_equals_a_whole_load(spark, tmp_path):
    root = str(tmp_path / "store")
    load(spark, root, range(20), buckets=16)
    load(spark, root, range(10, 30), mark="m")
    merged = B.read_store(spark, root)
    plain, _ = S.load(S.empty_store(spark), spark.createDataFrame(raw_rows(range(20)), RAW_SCHEMA))
    plain, _ = S.load(plain, spark.createDataFrame(raw_rows(range(10, 30), "m"), RAW_SCHEMA))
    for name, cols in (("articles", ("id", "url", "content_hash", "title", "body")), ("tags", ("id", "name")),
                       ("article_tags", ("article_id", "tag_id"))):
        assert sorted(map(repr, merged[name].select(*cols).collect())) == sorted(map(repr, plain[name].select(*cols).collect()))


def test_a_dead_load_is_invisible_and_versions_expire(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    for mark in ("a", "b", "c"):
        load(spark, root, range(10), mark=mark, buckets=4)
    before = {n: shown(B.read_store(spark, root), n) for n in B.KEYS}
    monkeypatch.setattr(B._Load, "commit", lambda self: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        load(spark, root, range(10), mark="dead")
    assert before == {n: shown(B.read_store(spark, root), n) for n in B.KEYS}
    dead = [v for v in os.listdir(f"{root}/articles") if not os.path.exists(f"{root}/states/{v}.json")]
    assert len(dead) == 1
    assert B.expire(spark, root, keep=2) > 0
    states = [s for s in os.listdir(f"{root}/states") if s.endswith(".json")]
    assert len(states) == 2 and not os.path.exists(f"{root}/articles/{dead[0]}")
    assert before == {n: shown(B.read_store(spark, root), n) for n in B.KEYS}
    for state in states:                        # both states can still be read
        own = json.load(open(f"{root}/states/{state}"))
        assert B.read_table(spark, root, own, "articles").count() == 10
    assert B.expire(spark, root, keep=2) == 0


def test_catalog_tables_have_fresh_statistics(spark, tmp_path):
    root, db = str(tmp_path / "store"), "lectern_stats"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    try:
        load(spark, root, range(25), buckets=4)
        B.register_tables(spark, root, db)
        assert B.row_counts(spark, db)["articles"] == 25 and B.row_counts(spark, db)["chunks"] == 50
        load(spark, root, [3, 4, 90], mark="n")
        B.register_tables(spark, root, db)
        counts = B.row_counts(spark, db)
        store = B.read_store(spark, root)
        assert counts == {n: store[n].count() for n in B.KEYS if n in counts} and counts["articles"] == 26
        assert spark.sql(f"SELECT body FROM {db}.articles WHERE url = 'https://x/3'").first()[0] == "text 3 n"
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_bad_rows_stop_a_load(spark, tmp_path):
    root = str(tmp_path / "store")
    raw = spark.createDataFrame(raw_rows([1]), RAW_SCHEMA)
    chunks = spark.createDataFrame([(1, 0, "c", [1.0])], "article_id long, position int, text string, embedding array<float>")
    with pytest.raises(ValueError, match="vectors"):
        B.merge_load(spark, root, raw, chunk_vectors=chunks, expected_dimension=2)
    with pytest.raises(ValueError, match="not in the batch"):
        B.merge_load(spark, root, raw, chunk_vectors=chunks.withColumn("article_id", F.lit(7).cast("long")))
    with pytest.raises(ValueError, match="tone"):
        B.merge_load(spark, root, raw, tone=spark.createDataFrame([(1, 0.1, 1.2, 0.1, 0.1)], TONE))
    assert B.read_store(spark, root)["articles"].count() == 0
