from lectern.operators import store as S
from lectern.plans import corpus


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_single_keys_are_not_sorted(spark):
    """wide rows meet a window only where their key repeats."""
    old = spark.createDataFrame([(1, 0, "old 0", [1.0]), (1, 1, "old 1", [1.0])],
                                "article_id long, position int, text string, embedding array<float>")
    new = spark.createDataFrame([(10, 0, "new 0", [2.0]), (20, 0, "other", [3.0])],
                                "article_id long, position int, text string, embedding array<float>")
    ids = spark.createDataFrame([(10, "a", 1), (20, "b", 2)], "source_id long, url string, id long")
    got = S.upsert_chunks(old, new, ids)
    assert "Window" not in _plan(got)
    assert sorted((r.article_id, r.position, r.text) for r in got.collect()) == [(1, 0, "new 0"), (1, 1, "old 1"), (2, 0, "other")]
    twice = ids.unionByName(spark.createDataFrame([(30, "a", 1)], ids.schema))
    more = new.unionByName(spark.createDataFrame([(30, 0, "newest", [4.0])], new.schema))
    assert sorted((r.article_id, r.text) for r in S.upsert_chunks(old, more, twice).collect()) == [
        (1, "newest"), (1, "old 1"), (2, "other")]


def test_latest_rows_take_null_keys_as_one(spark):
    rows = [(None, 1, "x"), (None, 2, "y"), ("a", 3, "z"), ("b", 4, "v"), ("b", 5, "w")]
    df = spark.createDataFrame(rows, "url string, source_id long, body string")
    want = S.latest_per_key(df, ["url"], "source_id").collect()
    assert sorted(r.body for r in S.latest_rows(df, ["url"], "source_id").collect()) == sorted(r.body for r in want) == ["w", "y", "z"]


def test_vectors_of_some_articles_equal_those_among_all(spark, tmp_path):
    """centroids need the labelled articles' vectors alone."""
    spark.createDataFrame([(i, f"text of number {i} " * 60, "en", f"s{i % 3}", 10) for i in range(20)],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    some = spark.createDataFrame([(3,), (7,), (7,)], "article_id long")
    got = corpus.chunk_vectors(spark, str(tmp_path), of=some).collect()
    every = corpus.chunk_vectors(spark, str(tmp_path)).where("article_id in (3, 7)").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, every)) and got
