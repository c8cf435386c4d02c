"""What a worker holds while it cuts texts, and the overlap of chunks cut once."""

import pyarrow as pa

from lectern.operators import chunk as C
from lectern.plans import catalog


def test_texts_are_cut_a_slice_at_a_time(monkeypatch):
    texts = [None, "", "word " * 300, "ü" * 2000, "one two", "x y " * 500]
    batch = pa.RecordBatch.from_pydict({"article_id": pa.array(range(6), pa.int64()), "_text": pa.array(texts, pa.string())})
    held = []
    slices = C.row_slices
    monkeypatch.setattr(C, "row_slices", lambda b, c: (held.append(s.nbytes) or s for s in slices(b, c, 1000)))
    out = [r for b in C._chunk_rows(["article_id"], "_text", 100, 20)([batch]) for r in b.to_pylist()]
    assert len(held) >= 4
    assert [(r["article_id"], r["idx"], r["chunk_text"]) for r in out] == [
        (i, j, c) for i, t in enumerate(texts) for j, c in enumerate(C.split_text(t, 100, 20))]


def test_pair_overlap_cuts_chunks_once(spark, tmp_path):
    text = "übung macht den meister " * 90
    rows = [(1, text, "en", "a"), (2, "kurz", "de", "b"), (3, None, "de", "b"), (4, "a" * 1900, "en", "a"), (4, "a" * 1900, "en", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    df = catalog.QUERIES["pair_overlap"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan
    want = []
    for i, t, *_ in rows:
        a = C.split_text(t)
        for k in range(len(a) - 1):
            want += [(i, k, C.longest_overlap(a[k], a[k + 1]))] * (2 if i == 4 else 1)
    assert sorted(map(tuple, df.collect())) == sorted(want)
