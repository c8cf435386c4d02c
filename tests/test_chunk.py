from pyspark.sql import functions as F

from lectern.operators.chunk import chunk_articles, longest_overlap, rebuild, reconstruct_articles, split_text


def test_space_free_text_is_cut_on_characters():
    text = "".join(str(i % 10) for i in range(1000))
    chunks = split_text(text)
    assert len(chunks) == 2
    assert all(len(c) <= 800 for c in chunks)
    assert chunks[0][-160:] == chunks[1][:160]


def test_words_pack_with_overlap():
    text = " ".join(f"w{i:03d}" for i in range(400))  # 1599 chars
    chunks = split_text(text, 100, 20)
    assert all(len(c) <= 100 for c in chunks)
    for a, b in zip(chunks, chunks[1:]):
        assert longest_overlap(a, b, 20) > 0 or a.split()[-1] != b.split()[0]
    assert " ".join(chunks).split()[0] == "w000" and chunks[-1].endswith("w399")


def test_long_piece_is_cut_without_overlap_to_neighbours():
    text = "short " + "x" * 900 + " tail"
    chunks = split_text(text, 800, 160)
    assert chunks[0] == "short"
    assert chunks[-1] == "tail"
    assert all(len(c) <= 800 for c in chunks)


def test_blank_and_null():
    assert split_text(None) == []
    assert split_text("   ") == []


def test_rebuild_merges_shared_region():
    text, spans = rebuild(["the cat sat on the mat", "on the mat and slept all day"])
    assert text == "the cat sat on the mat and slept all day"
    assert spans == [(0, 22), (12, 40)]


def test_rebuild_joins_with_space_without_overlap():
    text, spans = rebuild(["hello world", "goodbye moon"])
    assert text == "hello world goodbye moon"
    assert spans == [(0, 11), (12, 24)]


def test_rebuild_ignores_overlap_longer_than_cap():
    shared = "".join(f"{i:03d}" for i in range(67))[:200]
    text, spans = rebuild(["a" + shared, shared + "b"], 160)
    assert text == "a" + shared + " " + shared + "b"


def test_chunk_then_rebuild_on_fixture(spark):
    from lectern.plans import corpus
    ch = corpus.chunks(spark, "/root/testdata/sf0.001")
    assert ch.where(F.length("chunk_text") > 800).count() == 0
    rebuilt = reconstruct_articles(corpus.remap_chunks(ch))
    spans = rebuilt.select("text", F.explode("spans").alias("s"))
    rows = spans.limit(500).collect()
    chunk_text = {(r.article_id, r.idx): r.chunk_text for r in ch.collect()}
    ids = rebuilt.select("article_id", F.explode("spans").alias("s")).collect()
    txt = {r.article_id: r.text for r in rebuilt.collect()}
    for r in ids:
        assert txt[r.article_id][r.s.start:r.s.end] == chunk_text[(r.article_id, r.s.position)]
    assert rows


def test_chunk_articles_columns(spark):
    df = spark.createDataFrame([(1, "t", "a b c"), (2, "u", None)], "article_id long, title string, text string")
    out = chunk_articles(df).collect()
    assert [(r.article_id, r.idx, r.chunk_text) for r in out] == [(1, 0, "a b c")]


def test_packing_is_the_plain_rule():
    """Chunks found by looking ends up are those of adding and dropping piece by piece."""
    import random
    import re

    def plain(pieces, size, overlap):
        out, run, total = [], [], 0
        for piece in pieces:
            if total + len(piece) > size and run:
                out.append("".join(run).strip())
                while total > overlap or (total + len(piece) > size and total > 0):
                    total -= len(run.pop(0))
            run.append(piece)
            total += len(piece)
        return [t for t in [*out, "".join(run).strip()] if t]

    def whole(text, size, overlap):
        if " " not in text:
            return plain(text, size, overlap)
        out, run = [], []
        for piece in re.findall(r"^[^ ]+| [^ ]*", text):
            if len(piece) < size:
                run.append(piece)
            else:
                out += plain(run, size, overlap) + plain(piece, size, overlap)
                run = []
        return out + plain(run, size, overlap)
    rng = random.Random(4)
    for _ in range(3000):
        size = rng.choice([1, 2, 3, 5, 13, 40])
        overlap = min(rng.choice([0, 1, size // 3, size - 1, size]), size)
        text = "".join(rng.choice(rng.choice(["ab ", "a  ", "\t\n é日", "abc", "a   b"])) for _ in range(rng.randint(0, rng.choice([3, 20, 90]))))
        assert split_text(text, size, overlap) == whole(text, size, overlap), (text, size, overlap)
