from pyspark.sql import functions as F

from lectern.functions import text as TX


def _one(spark, col_fn, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(col_fn(F.col("v")).alias("o")).collect()[0].o


def test_normalize_text(spark):
    assert _one(spark, TX.normalize_text, "---\ntitle: x\n---\nHello\n  world\t\tagain ") == "Hello world again"
    assert _one(spark, TX.normalize_text, None) == ""


def test_normalize_title(spark):
    assert _one(spark, TX.normalize_title, " Some Title | Site ") == "Some Title"
    assert _one(spark, TX.normalize_title, None) == ""


def test_normalize_date(spark):
    assert _one(spark, TX.normalize_date, "2020-01-05") == "2020-01-05"
    assert _one(spark, TX.normalize_date, "05/01/2020") == "2020-05-01"
    assert _one(spark, TX.normalize_date, "25/01/2020") == "2020-01-25"
    assert _one(spark, TX.normalize_date, "March 3, 2021") == "2021-03-03"
    assert _one(spark, TX.normalize_date, "2020") == ""
    assert _one(spark, TX.normalize_date, "garbage") == ""


def test_parse_published_at(spark):
    import datetime
    assert _one(spark, TX.parse_published_at, " 2021-02-03T10:00 ") == datetime.date(2021, 2, 3)
    assert _one(spark, TX.parse_published_at, "nope") is None
    assert _one(spark, TX.parse_published_at, "") is None


def test_tags_and_urls(spark):
    df = spark.createDataFrame([([" a ", None, "", "b", "a"],)], "t array<string>")
    assert df.select(TX.normalize_tags(F.col("t")).alias("o")).collect()[0].o == ["a", "b", "a"]
    u = spark.createDataFrame([("https://x/library/abc",), ("https://x/library/",), ("https://x/other",)], "v string")
    assert [r.v for r in u.where(TX.is_article_url(F.col("v"))).collect()] == ["https://x/library/abc"]


def test_longest_overlap(spark):
    df = spark.createDataFrame([("abcde", "cdefg"), ("abc", "xyz"), ("", "a")], "l string, r string")
    got = [r.o for r in df.select(TX.longest_overlap(F.col("l"), F.col("r")).alias("o")).collect()]
    assert got == [3, 0, 0]
