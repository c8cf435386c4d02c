from pyspark.sql import functions as F

from lectern.operators.windows import sentence_windows, sentences, window_home_chunk


def _windows(spark, text):
    df = spark.createDataFrame([(1, text)], "article_id long, text string")
    return sentence_windows(sentences(df)).orderBy("window_index").collect()


def test_window_counts(spark):
    assert len(_windows(spark, "One. Two. Three.")) == 6
    assert len(_windows(spark, "A a. B b. C c. D d. E e.")) == 12
    assert len(_windows(spark, "Only one sentence")) == 1


def test_window_text_equals_slice(spark):
    text = "First one here.  Second?! Third \"quoted.\" Fourth"
    for w in _windows(spark, text):
        assert w.text == text[w.start:w.end]
        assert w.window_count == 9
    idx = [w.window_index for w in _windows(spark, text)]
    assert idx == list(range(9))


def test_sentence_offsets(spark):
    df = spark.createDataFrame([(1, "  Hi there. Bye now!  ")], "article_id long, text string")
    s = sentences(df).orderBy("sentence_index").collect()
    assert [(r.start, r.end) for r in s] == [(2, 11), (12, 20)]


def test_home_chunk_tie_goes_to_lower_position(spark):
    w = spark.createDataFrame([(1, 0, 10, 20)], "article_id long, window_index int, start int, end int")
    s = spark.createDataFrame([(1, 0, 0, 20), (1, 1, 10, 30)], "article_id long, position int, start int, end int")
    assert window_home_chunk(w, s).collect()[0].chunk_position == 0
