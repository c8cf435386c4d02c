from lectern.operators.rerank import greedy_non_overlapping, top_hits


def test_greedy_keeps_best_and_disjoint(spark):
    rows = [(1, 7, 1, 0, 0, 10, 0.95), (1, 7, 1, 1, 5, 15, 0.90), (1, 7, 1, 2, 20, 30, 0.80)]
    df = spark.createDataFrame(rows, "query_id long, article_id long, article_rank int, window_index int, "
                                     "start int, end int, score double")
    kept = top_hits(greedy_non_overlapping(df), 5).orderBy("hit_rank").collect()
    assert [r.score for r in kept] == [0.95, 0.80]


def test_window_cap_prefers_best_article(spark):
    from lectern.operators.windows import cap_windows
    sel = spark.createDataFrame([(1, 10, 0), (1, 20, 0)], "query_id long, article_id long, window_index int")
    ranks = spark.createDataFrame([(1, 10, 2), (1, 20, 1)], "query_id long, article_id long, article_rank int")
    out = cap_windows(sel, ranks, 1).collect()
    assert [r.article_id for r in out] == [20]
