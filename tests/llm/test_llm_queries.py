"""Registered queries against DuckDB, held-out accuracy, and the pipeline
against a plain one."""

import re

import duckdb
import pytest

import corpus_pipeline
from lectern.llm import language_id, url_filter
from lectern.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def duck(sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    rel = duck(SMALL).execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    want = sorted(rel.fetchall(), key=repr)
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == want


def test_language_accuracy_on_held_out_rows(spark):
    d = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op8_language_id"](spark, MIDDLE).join(d, "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == 1000 and len(held) > 250
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all() and not got.rejected.any()


def test_url_accuracy_on_held_out_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    held = F.pmod(F.xxhash64("url"), F.lit(3)) == 0
    got = (url_filter.judge_urls(pages, held_out=held).join(pages.select("page_id", held.alias("held")), "page_id")
           .filter("held and rule is not null").toPandas())
    right = (got.score > 0.5) == (got.verdict == "block")
    assert len(got) > 200 and right.mean() > 0.9


def test_shards_are_near_equal(spark):
    got = QUERIES["op3_kd_sharding"](spark, MIDDLE).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(got) == 1000 and list(sizes.index) == list(range(16))
    assert sizes.max() < 1.1 * sizes.mean() and sizes.min() > 0.9 * sizes.mean()
    assert got.groupby(["size", "text_crc32"]).shard.nunique().max() == 1


def test_sampled_pieces_are_lossless(spark):
    got = QUERIES["op10_sentencepiece_sampling"](spark, SMALL).toPandas()
    assert len(got) == 200 and got.lossless.all() and (got.n_pieces > 0).all()


def test_licences_of_the_fixture(spark):
    got = QUERIES["op9_license_scan"](spark, SMALL).toPandas()
    texts = dict(duck(SMALL).execute("select doc_id, text from documents").fetchall())
    lines = {(d, i) for d, t in texts.items() for i, x in enumerate(t.split("\n"))
             if re.search("licensed under|MIT License|All rights reserved", x, re.I) and len(x) < 80}
    assert lines <= {(r.doc_id, r.start_line) for r in got.itertuples()}


def test_personal_data_of_the_fixture(spark):
    got = QUERIES["op5_personal_data"](spark, SMALL).toPandas()
    texts = dict(duck(SMALL).execute("select doc_id, text from documents").fetchall())
    emails = {d: len(re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", t)) for d, t in texts.items()}
    assert dict(zip(got.doc_id, got.n_email)) == emails


def test_pipeline_matches_a_plain_one(spark):
    """Exact copies, near copies and benchmark passages by plain Python."""
    con = duck(SMALL)
    docs = con.execute("select doc_id, text, lang from documents").fetchall()
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)                     # noqa: E731
    last = {}
    for d, t, _ in docs:
        last[t] = max(d, last.get(t, d))
    kept = sorted((d, t) for t, d in last.items())
    sets = {}
    for d, t in kept:
        w = lower(t).split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    label = {d: d for d, _ in kept}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    kept = [(d, t) for d, t in kept if label[d] == d]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    tests = set()
    for (t,) in con.execute("select text from benchmark").fetchall():
        w = word.findall(lower(t))
        n = min(10, len(w))
        tests |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
    sizes = {len(t) for t in tests}
    def clean(t):
        w = word.findall(lower(t))
        return not any(tuple(w[i:i + n]) in tests for n in sizes for i in range(len(w) - n + 1))
    want = {d for d, t in kept if clean(t)}
    got = corpus_pipeline.run(spark, SMALL).toPandas()
    assert set(got.doc_id) == want and len(got) == len(want) and got.lossless.all()


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS and out.count() == 0, name
    assert language_id.UNKNOWN == "und"
