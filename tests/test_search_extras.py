from pyspark.sql import functions as F

from lectern.operators import shortlist as SL
from lectern.operators.textindex import postings, search
from tests.conftest import SF001


def test_ivf_with_all_lists_equals_exact(spark):
    from lectern.plans import corpus
    from lectern.operators.encode import encode_queries
    from lectern.sources.tables import queries_table
    cv = corpus.chunk_vectors(spark, SF001).select("article_id", "position", "embedding").cache()
    qv = encode_queries(queries_table(spark, SF001)).where(F.col("query_id") < 5)
    cents, idx = SL.build_lists(cv, 4)
    approx = SL.ivf_shortlist(qv, idx, cents, k=10, probes=4)
    exact = SL.shortlist(qv, cv, k=10)
    key = ["query_id", "article_id", "position", "rank"]
    assert sorted(map(tuple, approx.select(key).collect())) == sorted(map(tuple, exact.select(key).collect()))


def test_text_search_and_mode(spark):
    docs = spark.createDataFrame([(1, "red apple pie"), (2, "red car"), (3, "green apple")],
                                 "article_id long, text string")
    q = spark.createDataFrame([(1, "red apple")], "query_id long, query string")
    p = postings(docs)
    assert {r.article_id for r in search(q, p, mode="and").collect()} == {1}
    assert {r.article_id for r in search(q, p, mode="or").collect()} == {1, 2, 3}
    pos = {(r.term, r.article_id): r.positions for r in p.collect()}
    assert pos[("pie", 1)] == [3]
