import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"query_id", "hit_rank", "text", "score", "article_id"} <= set(df.columns)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
