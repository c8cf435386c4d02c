"""Ids, keys under repeated urls, the store's pointer, the stream, models."""

import functools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.functions.ids import dense_ids
from lectern.functions.models import MAX_MODELS, model_key, worker_model
from lectern.operators import buckets as B
from lectern.operators import store as S
from lectern.operators.encode import HashedBagOfWords, encode_column
from lectern.operators.quality import star_violations
from lectern.operators.shortlist import ivf_shortlist, shortlist, write_lists
from lectern.operators.tone import score_matrix
from lectern.operators.vectors import centroids, mean_pool
from lectern.plans import quote_search as QS
from lectern.plans.evaluation import eval_expected_urls
from lectern.sources import files as IO
from lectern.streaming.ingest import RAW_SCHEMA, process_batch, start_ingest
from lectern.plans.corpus import remap_chunks
from lectern.operators.chunk import chunk_articles
from lectern.operators.encode import encode_chunks


def test_dense_ids_with_a_payload_column(spark):
    n = 20_000
    df = spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k"), F.repeat(F.lit("x"), 200).alias("payload"))
    got = dense_ids(df, "k").select("k", "id")
    row = got.agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    assert (row.n, row.d, row.lo, row.hi) == (n, n, 1, n)
    rows = got.orderBy("k").collect()
    assert [r.id for r in rows] == list(range(1, n + 1))


def test_dense_ids_of_equal_and_null_keys(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    assert sorted(((r.v, r.id) for r in dense_ids(df, "k", start=5).collect())) == [(1, 6), (2, 5), (3, 6), (4, None)]


RAW = [(1, "u/a", "A", None, "2020-01-01", "first a", ["x"]), (2, "u/b", "B", None, "2020-01-01", "only b", ["y"]),
       (3, " u/a ", "A2", None, "2020-01-02", "second a", ["z"])]


def test_repeated_urls_keep_the_keys(spark):
    raw = spark.createDataFrame(RAW, RAW_SCHEMA)
    chunks = spark.createDataFrame([(1, 0, "old 0", [1.0]), (1, 1, "old 1", [1.0]), (2, 0, "b", [1.0]), (3, 0, "new 0", [2.0])],
                                   "article_id long, position int, text string, embedding array<float>")
    asg = spark.createDataFrame([(1, 7, 0.5, []), (3, 8, 0.9, [])], "article_id long, topic_id int, topic_prob double, "
                                "secondary_topics array<struct<topic_id:int,probability:double>>")
    tone = spark.createDataFrame([(1, 0.1, 0.1, 0.1, 0.1), (3, 0.2, 0.2, 0.2, 0.2)],
                                 "article_id long, academic double, militant double, hopeful double, critical double")
    store, _ = S.load(S.empty_store(spark), raw, chunks, asg, tone=tone)
    assert star_violations(store).count() == 0
    a = {r.url: r for r in store["articles"].collect()}
    assert set(a) == {"u/a", "u/b"} and a["u/a"].title == "A2" and a["u/a"].topic_id == 8
    own = {(r.article_id, r.position): r.text for r in store["chunks"].collect()}
    assert own == {(a["u/a"].id, 0): "new 0", (a["u/a"].id, 1): "old 1", (a["u/b"].id, 0): "b"}
    assert [(r.article_id, r.academic) for r in store["tone"].collect()] == [(a["u/a"].id, 0.2)]
    report = S.repeated_urls(S.prepare_batch(raw)).collect()
    assert [(r.url, r.n_rows, r.kept_source_id) for r in report] == [("u/a", 2, 3)]


def test_pointer_is_replaced_and_its_loss_is_an_error(spark, tmp_path):
    root = str(tmp_path / "store")
    assert B.read_store(spark, root)["articles"].count() == 0
    one, _ = S.load(S.empty_store(spark), spark.createDataFrame(RAW[:1], RAW_SCHEMA))
    B.write_store(one, root)
    two, _ = S.load(B.read_store(spark, root), spark.createDataFrame(RAW[1:2], RAW_SCHEMA))
    B.write_store(two, root)
    assert B.read_store(spark, root)["articles"].count() == 2
    os.remove(f"{root}/{B.POINTER}")
    with pytest.raises(RuntimeError):
        B.read_store(spark, root)


def _land(spark, path, rows):
    spark.createDataFrame(rows, RAW_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    rows = [(i, f"u/{i:03d}", f"t{i}", None, "2021-05-06", f"text number {i} about topic {i % 2} " * 5, ["x"]) for i in range(12)]
    raw = spark.createDataFrame(rows, RAW_SCHEMA)
    vec = remap_chunks(encode_chunks(chunk_articles(raw.select("article_id", "title", "text"))))
    cents = centroids(mean_pool(vec).withColumn("topic_id", (F.col("article_id") % 2).cast("int")), "topic_id")
    _land(spark, f"{base}/landing", rows[:8])
    start_ingest(spark, f"{base}/landing", f"{base}/store", f"{base}/c1", cents).awaitTermination()
    _land(spark, f"{base}/landing", rows[8:])
    start_ingest(spark, f"{base}/landing", f"{base}/store", f"{base}/c1", cents).awaitTermination()
    streamed = B.read_store(spark, f"{base}/store")

    def view(store, name, *cols):
        return sorted(map(repr, store[name].select(*cols).collect()))
    process_batch(spark, raw, f"{base}/batch", cents)
    batch = B.read_store(spark, f"{base}/batch")
    for name, cols in (("articles", ("id", "url", "content_hash", "topic_id", "topic_prob")),
                       ("chunks", ("article_id", "position", "text")), ("tags", ("id", "name")),
                       ("tone", ("article_id", "academic", "critical"))):
        assert view(streamed, name, *cols) == view(batch, name, *cols), name
    assert {r.topic_id for r in streamed["articles"].collect()} == {0, 1}
    assert streamed["articles"].agg(F.min("created_at")).first()[0].year > 2020
    before = {n: view(streamed, n, *streamed[n].columns) for n in B.KEYS}
    versions = set(os.listdir(f"{base}/store"))
    assert process_batch(spark, raw, f"{base}/store", cents) is None       # a replay
    after = B.read_store(spark, f"{base}/store")
    assert before == {n: view(after, n, *after[n].columns) for n in B.KEYS}
    assert set(os.listdir(f"{base}/store")) == versions
    changed = spark.createDataFrame([(3, "u/003", "t3", None, "2021-05-06", "another text", ["x"])], RAW_SCHEMA)
    process_batch(spark, changed, f"{base}/store", cents)
    assert B.read_store(spark, f"{base}/store")["articles"].where("url = 'u/003'").first().body == "another text"


def test_models_are_built_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    class Counted(HashedBagOfWords):
        def __init__(self):
            super().__init__(8)
            open(f"{folder}/{os.getpid()}-{os.urandom(4).hex()}", "w").close()

    df = spark.range(64).select(F.col("id").cast("string").alias("text")).repartition(32)
    out = encode_column(df, "text", encoder_factory=Counted, dim=8)
    assert out.agg(F.sum(F.size("embedding"))).first()[0] == 512
    pids = [f.split("-")[0] for f in os.listdir(tmp_path)]
    assert pids and len(pids) == len(set(pids))


def test_model_keys():
    assert model_key(functools.partial(HashedBagOfWords, 8)) == model_key(functools.partial(HashedBagOfWords, 8))
    assert model_key(functools.partial(HashedBagOfWords, 8)) != model_key(functools.partial(HashedBagOfWords, 9))
    a = lambda: 1                                                     # noqa: E731
    assert model_key(a) != model_key(lambda: 2)
    for i in range(2 * MAX_MODELS):
        assert worker_model(f"k{i}", lambda i=i: i) == i


def test_score_matrix():
    labels = ("academic", "militant")
    out = score_matrix([{"labels": ["MILITANT", "academic"], "scores": [0.2, 0.8]}], 1, labels)
    assert out.tolist() == [[0.8, 0.2]]
    good = {"labels": list(labels), "scores": [0.1, 0.2]}
    for outputs, n in (([good], 2), ([{"labels": ["academic"], "scores": [0.1]}], 1),
                       ([{"labels": ["academic", "academic"], "scores": [0.1, 0.2]}], 1),
                       ([{"labels": ["academic", "other"], "scores": [0.1, 0.2]}], 1),
                       ([{**good, "scores": [0.1, 1.2]}], 1), ([{**good, "scores": [0.1, float("nan")]}], 1)):
        with pytest.raises(ValueError):
            score_matrix(outputs, n, labels)


def test_queries_are_bounded(spark):
    ok = spark.createDataFrame([(1, "x" * 512)], "query_id long, query string")
    QS.require_queries(ok)
    for text in (" \n ", "", None, "x" * 513):
        with pytest.raises(ValueError):
            QS.require_queries(spark.createDataFrame([(1, "fine"), (2, text)], "query_id long, query string"))


def test_topic_and_tag_filters(spark):
    vec = spark.createDataFrame([(i, 0, f"the words of text {i} .", [1.0, float(i)]) for i in range(1, 5)],
                                "article_id long, position int, text string, embedding array<float>")
    arts = spark.createDataFrame([(i, i % 2) for i in range(1, 5)], "id long, topic_id int")
    tags = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "article_id long, name string")
    got = QS.filter_chunks(vec, arts, topic_id=1, tag="a", article_tags=tags)
    assert [r.article_id for r in got.collect()] == [1]
    with pytest.raises(ValueError):
        QS.filter_chunks(vec, arts, tag="a")


def test_evaluation_by_expected_url(spark, tmp_path):
    path = tmp_path / "quotes.json"
    path.write_text('[{"query": "q one", "expected_url": "https://x/a/", "notes": ""},'
                    ' {"query": "q two", "expected_url": "https://x/z", "notes": null}]')
    labelled = IO.read_eval_queries(spark, str(path)).withColumn(
        "query_id", F.when(F.col("query") == "q one", 1).otherwise(2).cast("long"))
    hits = spark.createDataFrame([(1, 1, "https://x/b"), (1, 2, "https://x/a"), (2, 1, "https://x/a")],
                                 "query_id long, hit_rank int, article_url string")
    got = {r.query_id: (r.first_relevant, r.hit_at_k, r.reciprocal_rank) for r in eval_expected_urls(hits, labelled).collect()}
    assert got == {1: (2, 1, 0.5), 2: (None, 0, 0.0)}


def test_lists_are_folders_that_probes_prune(spark):
    rng = np.random.default_rng(0)
    corpus = spark.createDataFrame([(i, 0, [float(x) for x in rng.normal(size=6)]) for i in range(200)],
                                   "article_id long, position int, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0])], "query_id long, embedding array<double>")
    cents, folder = write_lists(corpus, 6)
    some = ivf_shortlist(queries, spark.read.parquet(folder), cents, k=5, probes=2)
    plan = some._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [list_id" in plan
    every = ivf_shortlist(queries, spark.read.parquet(folder), cents, k=5, probes=6).select("article_id").collect()
    exact = shortlist(queries, corpus, k=5).select("article_id").collect()
    assert every == exact


def test_bad_vectors_are_refused(spark, tmp_path):
    schema = "article_id long, title string, embedding array<float>"
    for rows in ([(1, "t", [1.0, float("nan")])], [(1, "t", [1.0])], [(1, "t", [1.0, 2.0]), (1, "t", [1.0, 2.0])]):
        with pytest.raises(ValueError):
            IO.write_article_vectors(spark.createDataFrame(rows, schema), str(tmp_path / "v"), 2)
    mixed = spark.createDataFrame([(1, "a", [1.0]), (1, "b", [1.0])], schema)
    with pytest.raises(ValueError):
        mean_pool(mixed, carry=("title",), check=True)


def test_tone_of_the_fixture_is_not_zero(spark):
    from lectern.plans.star import tone
    from tests.conftest import SF001
    sums = tone(spark, SF001).groupBy().sum("academic", "militant", "hopeful", "critical").first()
    assert all(v > 0 for v in sums)


def test_tag_frequency_reads_documents_once(spark):
    from lectern.plans import star as ST
    from tests.conftest import SF001
    plan = ST.tag_frequency(ST.star(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "documents.parquet" not in plan
