import json

import pytest
from pyspark.sql import functions as F

from lectern.plans import corpus
from lectern.plans.stages import StageError, run_pipeline
from lectern.sources import files as IO
from tests.conftest import SF001


def test_parquet_files_rules(spark, tmp_path):
    d = tmp_path / "shards"
    spark.range(3).write.parquet(str(tmp_path / "tmp"))
    d.mkdir()
    with pytest.raises(FileNotFoundError):
        IO.parquet_files(spark, str(d))
    (d / "b.parquet").write_bytes((next((tmp_path / "tmp").glob("*.parquet"))).read_bytes())
    (d / "a.pq").write_bytes((d / "b.parquet").read_bytes())
    (d / "notes.txt").write_text("x")
    assert [p.rsplit("/", 1)[1] for p in IO.parquet_files(spark, str(d))] == ["a.pq", "b.parquet"]
    with pytest.raises(ValueError):
        IO.parquet_files(spark, str(d / "notes.txt"))
    with pytest.raises(FileNotFoundError):
        IO.parquet_files(spark, str(tmp_path / "missing"))


def test_raw_shards_and_exports(spark, tmp_path):
    arts = corpus.raw_articles(spark, SF001)
    IO.write_raw_shards(arts, str(tmp_path / "raw"), rows_per_file=60)
    files = IO.parquet_files(spark, str(tmp_path / "raw"))
    assert len(files) >= 4
    back = IO.read_articles(spark, str(tmp_path / "raw"))
    assert back.count() == arts.count() and "filename" in back.columns
    IO.export_view(arts.select("article_id", "tags"), str(tmp_path / "csv"), "csv")
    row = spark.read.option("header", True).csv(str(tmp_path / "csv")).first()
    assert "|" in row.tags
    q = tmp_path / "eval.json"
    q.write_text(json.dumps([{"query": "a b", "expected_url": "u", "notes": "n"}]))
    assert IO.read_eval_queries(spark, str(q)).first().expected_url == "u"
    assert IO.read_topic_assignments(spark, str(tmp_path / "nothing")) is None


def test_staged_pipeline(spark, tmp_path):
    raw = tmp_path / "raw"
    IO.write_raw_shards(corpus.raw_articles(spark, SF001).where(F.col("article_id") < 120), str(raw), 50)
    root = str(tmp_path / "run")
    with pytest.raises(ValueError):
        run_pipeline(spark, str(raw), root, start="bogus")
    summary = run_pipeline(spark, str(raw), root, n_topics=3, min_cluster_size=5).collect()[0]
    assert summary.articles == 120 and summary.chunks > 120
    cleaned = spark.read.parquet(root + "/cleaned")
    assert cleaned.select("shard").distinct().count() == len(IO.parquet_files(spark, str(raw)))
    from lectern.operators.buckets import read_store
    st = read_store(spark, root + "/store")
    assert st["articles"].count() == 120
    assert st["articles"].where(F.col("topic_id").isNotNull()).count() == 120
    from lectern.operators.topics import load_models
    models = load_models(root + "/topics/model")
    assert set(models) == {"pca", "gmm"}
    # restarting from a later stage reads the saved artifacts
    run_pipeline(spark, str(raw), root, start="tone")
    with pytest.raises(StageError) as e:
        run_pipeline(spark, str(tmp_path / "empty"), str(tmp_path / "run2"))
    assert e.value.stage == "chunk"


def test_lookups(spark):
    from lectern.plans import star as ST
    t = spark.createDataFrame([(1, "x", None, 3)], "id int, label string, top_terms array<string>, size int")
    assert ST.get_topic(t, 1)["top_terms"] == []
    with pytest.raises(LookupError):
        ST.get_topic(t, 2)


def test_sitemap_urls(spark):
    from lectern.functions.text import sitemap_urls
    text = "https://x/library/a\nhttps://x/library/\r\nhttps://x/other/b\n https://x/library/c "
    got = spark.createDataFrame([(text,)], "t string").select(sitemap_urls(F.col("t")).alias("u")).first().u
    assert got == ["https://x/library/a", "https://x/library/c"]


def test_evaluation_summary(spark):
    from lectern.plans.evaluation import summary
    per_query = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.0)], "query_id long, hit_at_k long, reciprocal_rank double")
    assert tuple(summary(per_query).first()) == (2, 0.5, 0.25)
