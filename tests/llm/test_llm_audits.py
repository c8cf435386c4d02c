"""Quality classifier, filter audit and source divergences against brute force,
on small tables with awkward rows."""

import math
import random
import re
import time
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import decontaminate, filter_audit, quality, sentence_pieces, source_divergence
from lectern.llm import wordhash as W
from lectern.llm.queries import QUERIES

SPACE = " \t\n\r\x0b\x0c"
SCHEMA = "doc_id long, text string, lang string, source string, part string, score string, term string, quality int, q_words int"


def rows():
    rng = random.Random(11)
    words = [f"w{chr(97 + i)}x" for i in range(40)] + ["Über", "ÉCOLE", "naïve", "日本", "x-y", "$a", "A|B", "Ünï"]
    def say(n):
        return " ".join(rng.choice(words) for _ in range(n))
    out = [(i, say(rng.randint(1, 140)), rng.choice(["en", "de", "fr", None]), f"s{i % 4}", "p", "s", "t", 1, 3) for i in range(60)]
    copy = say(80)
    out += [(70 + i, copy, "en", f"s{i % 3}", None, None, None, None, None) for i in range(9)]
    out += [(5, copy, "en", "s0", "p", "s", "t", 1, 3), (5, copy, "en", "s9", "p", "s", "t", 1, 3),     # a repeated id
            (100, None, None, None, None, None, None, None, None), (101, "", "en", "", "p", "s", "t", 1, 3),
            (102, " \t\n ", "en", None, "p", "s", "t", 1, 3), (None, copy, "en", "s0", "p", "s", "t", 1, 3),
            (None, None, "de", "s0", "p", "s", "t", 1, 3), (103, "LOUD " * 300_000, "en", "s1", "p", "s", "t", 1, 3),
            (104, "y" * 2_100_000, "xx", "s1", "p", "s", "t", 1, 3), (105, "\x00\x01 ▁ é́ 🎈 $", "en", "s2", "p", "s", "t", 1, 3),
            (106, "!!!", "en", "s2", "p", "s", "t", 1, 3), (106, "!!!", "en", "s2", "p", "s", "t", 1, 3)]
    return out


LABELS = ([(i, i % 3 != 0, i % 5 == 0) for i in range(0, 75)] + [(0, 1, 1), (103, 0, None), (None, 1, 1), (9999, 1, 1), (70, None, 1)])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    made = [(i, None if q is None else int(q), None if t is None else int(t)) for i, q, t in LABELS]
    return spark.createDataFrame(made, "doc_id long, quality int, toxic int")


def words_of(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


# ---------------------------------------------------------------- filter audit

def plain_audit():
    data = [((r[3] or ""), r[0], r[1] or "") for r in rows()]
    ids = defaultdict(list)
    for _, i, x in data:
        if i is not None:
            ids[x].append(i)
    good = {i for i, q, _ in LABELS if q == 1 and i is not None}
    toxic = {i for i, _, t in LABELS if t == 1 and i is not None}
    fails = []
    for part, i, x in data:
        ws = words_of(x)
        fails.append((part, i, {f for f, bad in zip("ABCDE", (
            len(ws) < 50, 100 * len(set(ws)) < 65 * len(ws), 100 * len(re.findall("[A-Z]", x)) > 5 * len(x),
            bool(re.search("[#$%&*|]", x)), i is not None and any(j < i for j in ids[x]))) if bad}))
    out = {}
    for part in {p for p, _, _ in fails}:
        own = [(i, f) for p, i, f in fails if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order, 1):
                gone = [i for i, bad in left if f in bad]
                left = [(i, bad) for i, bad in left if f not in bad]
                shapley[f] += len(gone)
                out[part, "".join(order), k] = [
                    len(left), len(gone), sum(f in bad for _, bad in own) - len(gone), sum(bad == {f} for _, bad in own),
                    sum(i in good for i in gone), sum(i in toxic for i in gone)]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order, 1):
                out[part, "".join(order), k].append(shapley[f])
    return out


def test_filter_audit(docs, labels):
    got = {tuple(r)[:3]: list(r)[3:] for r in filter_audit.audit_filters(docs, labels).collect()}
    assert got == plain_audit()


def test_walk_is_the_sum_over_masks():
    cells = np.random.default_rng(3).integers(0, 50, (4, 16, 2))
    states = filter_audit.walk_subsets(cells, 4)
    for s in range(16):
        own = [m for m in range(16) if not m & s]
        assert (states[:, s] == cells[:, own].sum(axis=1)).all()


def test_words_of_a_long_text_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(filter_audit, "_PIECE", 7)
    for text in (b"", b"   ", b"abc", b"a bb ccc dddd eeeee ffffff ggggggg hhhhhhhh a bb ", b"x" * 50, b"1234567 1234567 12", b"\x0b a\x0c"):
        ws = text.split()
        assert filter_audit.count_words(text) == (len(ws), len(set(ws)))


def test_filter_audit_of_nothing(spark, docs, labels):
    assert filter_audit.audit_filters(docs.limit(0), labels).count() == 0
    got = filter_audit.audit_filters(docs, labels.limit(0))
    assert got.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


# ---------------------------------------------------------------- source divergence

def plain_divergence(data, min_docs, top):
    terms = [((r[2] or ""), (r[3] or ""), [w.translate({c: c + 32 for c in range(65, 91)}) for w in
              re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r[1] or "")]) for r in data]
    df, count, sources = Counter(), Counter(), defaultdict(set)
    for lang, source, ws in terms:
        sources[lang].add(source)
        df.update({(lang, w) for w in ws})
        count.update((lang, source, w) for w in ws)
    out = set()
    for lang, own in sources.items():
        kept = sorted(w for (la, w), d in df.items() if la == lang and d >= min_docs)
        n = {s: sum(count[lang, s, w] for w in kept) for s in own}
        whole = sum(n.values())
        def p(c, total):
            return 1 + 10**9 * (c + 1) // (total + len(kept))
        def f(a, b):
            return (a - b) ** 2 // b
        for s in own:
            found = {"pair": [], "term": []}
            for t in own - {s}:
                found["pair"].append((-sum(f(p(count[lang, s, w], n[s]), p(count[lang, t, w], n[t])) for w in kept), t))
            for w in kept:
                a, q = p(count[lang, s, w], n[s]), p(sum(count[lang, t, w] for t in own), whole)
                if count[lang, s, w] and a > q:
                    found["term"].append((-f(a, q), w))
            for part, items in found.items():
                for r, (v, item) in enumerate(sorted(items, key=lambda x: (x[0], x[1].encode())), 1):
                    if part == "pair" or r <= top:
                        out.add((lang, s, part, item, -v, r))
    return out


@pytest.mark.parametrize("shard_rows, pairs, at_once", [(200_000, 1 << 19, 1 << 20), (20, 9, 5)])
def test_source_divergence(docs, monkeypatch, shard_rows, pairs, at_once):
    monkeypatch.setattr(source_divergence, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(source_divergence, "PAIRS", pairs)
    got = source_divergence.source_divergences(docs, top=7).collect()
    want = plain_divergence(rows(), 3, 7)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_pair_sums_in_small_steps(monkeypatch):
    rng = np.random.default_rng(5)
    total, n_terms = rng.integers(1, 500, 6), 30
    cells = sorted({(int(t), int(s)) for t, s in zip(rng.integers(0, 20, 60), rng.integers(0, 6, 60))})
    term, source = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])
    n = rng.integers(1, 40, len(cells))
    whole = source_divergence.pair_sums(source, term, n, total, 100, n_terms, np.arange(6))
    dense = np.zeros((n_terms, 6), dtype=np.int64)
    dense[term, source] = n
    p = source_divergence.shares(dense, total, 100)
    assert (whole == source_divergence.divergence(p[:, :, None], p[:, None, :]).sum(axis=0)).all()
    monkeypatch.setattr(source_divergence, "_AT_ONCE", 3)
    assert (source_divergence.pair_sums(source, term, n, total, 100, n_terms, np.array([1, 4])) == whole[:, [1, 4]]).all()


def test_shares_stay_exact_with_large_counts():
    for c, total, v in ((0, 0, 1), (5, 5, 1), (10**14, 3 * 10**15, 10**9), (3 * 10**15, 3 * 10**15, 7)):
        assert source_divergence.shares(np.array([c]), total, v)[0] == 1 + 10**9 * (c + 1) // (total + v)


def test_source_divergence_of_little(spark, docs):
    assert source_divergence.source_divergences(docs.limit(0)).count() == 0
    bare = spark.createDataFrame([(1, "a b", "en", "x"), (2, None, "en", "y"), (3, "", "en", None)],
                                 "doc_id long, text string, lang string, source string")
    got = source_divergence.source_divergences(bare).collect()        # no term in three documents
    assert len(got) == 6 and {r.part for r in got} == {"pair"} and {r["value"] for r in got} == {0}


# ---------------------------------------------------------------- quality

def plain_counts(text):
    raw, ws = (text or "").encode(), words_of(text)
    letter = [c for c in (text or "") if c.isascii() and c.isalpha() or ord(c) > 127]
    alnum = set(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") | set(range(128, 256))
    points = len(text or "")
    by = {"points": points, "upper": len(re.findall("[A-Z]", text or "")), "letters": len(letter),
          "digits": len(re.findall("[0-9]", text or "")), "calls": raw.count(b"!"),
          "stops": sum(raw.count(c) for c in b"\"'(),-.:;?"), "again": len(ws) - len(set(ws)),
          "same_as_last": sum(a == b for a, b in zip(ws, ws[1:])), "open_ends": sum(w.encode()[-1] not in alnum for w in ws),
          "lines": raw.count(b"\n"), "words": len(ws)}
    by["signs"] = points - sum(by[k] for k in ("letters", "digits", "calls", "stops")) - sum(c < 33 or c == 127 for c in raw)
    return [by[c] for c in quality.COUNTS]


def test_quality_statistics(docs):
    got = quality.statistics(docs.select("doc_id", "text", "q_words")).collect()
    assert got[0].__fields__ == ["doc_id", *(f"q_{c}" for c in quality.COUNTS)]
    want = sorted(([r[0], *plain_counts(r[1])] for r in rows()), key=repr)
    assert sorted((list(r) for r in got), key=repr) == want


def test_quality_scores_against_plain_densities(docs, labels):
    stats = quality.statistics(docs.select("doc_id", "text", "score"))
    model = quality.fit(stats, labels)
    got = quality.score_documents(stats, model).toPandas()
    assert list(got.columns) == ["doc_id", "score"] and len(got) == len(rows())
    marks = defaultdict(set)
    for i, q, _ in LABELS:
        if i is not None and q is not None:
            marks[i].add(int(q))
    train = [(c, plain_counts(r[1])) for r in rows() if r[0] is not None for c in marks[r[0]]]
    counts = np.array([x for _, x in train], dtype=float)
    at = {n: counts[:, i] for i, n in enumerate(quality.COUNTS)}
    rates = np.array([at[s].sum() / at[b].sum() for s, b in quality.SHARES.items()])
    x, y = quality.transformed(counts, rates), np.array([c for c, _ in train])
    cov = {c: np.cov(x[y == c].T, bias=True) for c in (0, 1)}
    pooled = np.maximum(sum((y == c).mean() * np.diag(cov[c]) for c in (0, 1)), 1e-4)

    def log_density(v, c):
        s = (1 - quality.SHRINK) * cov[c] + np.diag(quality.SHRINK * pooled)
        d = v - x[y == c].mean(axis=0)
        return math.log((y == c).mean()) - 0.5 * d @ np.linalg.solve(s, d) - 0.5 * np.linalg.slogdet(s)[1]
    want = {}
    for r in rows():
        v = quality.transformed(np.array([plain_counts(r[1])], dtype=float), rates)[0]
        want[r[0], r[1]] = 1 / (1 + math.exp(min(max(log_density(v, 0) - log_density(v, 1), -700), 700)))
    shown = sorted(((-1 if i is None or math.isnan(i) else i), s) for i, s in zip(got.doc_id, got.score))
    plain = sorted(((-1 if r[0] is None else r[0]), want[r[0], r[1]]) for r in rows())
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-6 for a, b in zip(shown, plain))


def test_quality_without_labels_or_with_one_class(spark, docs, labels):
    stats = quality.statistics(docs.select("doc_id", "text"))
    assert quality.fit(stats, labels.limit(0)) is None
    assert {r.score for r in quality.score_documents(stats, None).collect()} == {0.5}
    one = quality.fit(stats, labels.filter("quality = 0"))
    assert {r.score for r in quality.score_documents(stats, one).collect()} == {0.0}
    assert quality.score_documents(quality.statistics(docs.select("doc_id", "text").limit(0)), one).count() == 0


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op11_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.96 and got.score.between(0, 1).all()


# ---------------------------------------------------------------- urls that repeat

def test_trees_learn_from_few_urls_that_repeat(spark):
    from lectern.llm import url_filter
    urls = [f"https://a{i}.com/{'fr' if i % 2 else 'de'}/p{i}" for i in range(10)]
    rows = [(i, urls[i % 10]) for i in range(4000)] + [(5000 + i, f"https://b{i}.net/{'fr' if i % 2 else 'de'}/q{i}") for i in range(10)]
    rows += [(6000, None), (6000, "no scheme"), (6001, "https://c.net/" + "x" * 100_000)]
    pages = spark.createDataFrame([(i, u, "h", "v", 1.0) for i, u in rows], "page_id long, url string, host string, verdict string, score double")
    got = url_filter.judge_urls(pages, train_rows=100).collect()
    assert len(got) == len(rows) and {r.verdict for r in got if r.page_id < 4000 and r.page_id % 10 % 2} == {"allow"}
    assert {r.verdict for r in got if r.page_id < 4000 and r.page_id % 2 == 0} == {"block"}
    by_url = {}
    for r in got:
        by_url.setdefault((r.host, r.path), set()).add((r.verdict, r.score))
    assert all(len(v) == 1 for k, v in by_url.items() if k[0].startswith("a"))       # copies are judged alike


# ---------------------------------------------------------------- pipeline stages on rows without an id

def test_stages_tell_rows_without_an_id_apart(spark, tmp_path):
    import corpus_pipeline as P
    rng = random.Random(3)
    def say(n):
        return " ".join(f"word{rng.randrange(500)}" for _ in range(n))
    base, leak = say(100), say(30)
    near = base.rsplit(" ", 1)[0] + " other"
    rows = [(7, base, "en", "s", 1), (None, near, "en", "s", 1), (None, say(90), "en", "s", 1), (7, say(80), "en", "s", 1),
            (-5, say(70), "en", "s", 1), (None, leak + " " + say(40), "en", "s", 1), (8, leak, None, None, None), (8, say(60), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([("b", leak)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = P.drop_near_copies(spark, docs, str(tmp_path))
    assert left.columns == list(P.COLUMNS)
    assert {r.text for r in left.collect()} == {r[1] for r in rows} - {near}
    clean = {r.text for r in P.drop_benchmark_copies(spark, docs, str(tmp_path)).collect()}
    assert clean == {r[1] for r in rows if leak not in r[1]}


# ------------------------------------------------------------------ benchmark passages


def _words_of(texts):
    buf = W.LOWER[np.frombuffer("".join(texts).encode(), dtype=np.uint8)]
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    starts, ends, first = W.find_words(buf, off, W.ALNUM)
    return W.run_hashes(buf, starts, ends), first


def test_matches_reach_as_far_as_any_item():
    rng = random.Random(3)
    for _ in range(60):
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))) for i in range(rng.randint(0, 9))]
        docs = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(4)]
        block = decontaminate._Block(items, 4)
        words, first = _words_of(docs)
        (text, start, end, item, at), (of, held) = decontaminate._matches(block, block.ids(words), first)
        got = {}
        for t, s, e, i, p in zip(text, start, end, item, at):
            assert docs[t].split()[s:e] == items[i][1].split()[p:p + e - s]
            got.setdefault(int(t), []).append((int(s), int(e)))
        for d, doc in enumerate(docs):
            w = doc.split()
            spans, names = set(), set()
            for i, (_, other) in enumerate(items):
                o = other.split()
                for s in range(len(w)):
                    for p in range(len(o) if len(o) >= 4 else min(len(o), 1)):
                        n = 0
                        while s + n < len(w) and p + n < len(o) and w[s + n] == o[p + n]:
                            n += 1
                        if n >= 4 or n and n == len(o):
                            spans.add((s, s + n))
                            names.add(i)
            most = sorted(x for x in spans if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in spans))
            assert got.get(d, []) == most
            assert sorted(held[of == d].tolist()) == sorted(names)


def test_a_preamble_of_many_items_is_matched_once_a_place():
    opening = " ".join(f"p{i}" for i in range(10))
    items = [(f"i{i:04}", f"{opening} own{i} words{i} here{i}") for i in range(2000)]
    block = decontaminate._Block(items, 10)
    words, first = _words_of([(opening + " and then ") * 2000])
    (_, start, end, _, _), (of, held) = decontaminate._matches(block, block.ids(words), first)
    assert len(start) == 2000 and set((end - start).tolist()) == {10}
    assert len(held) == 2000 and not of.any()


# ------------------------------------------------------------------ pieces of long segments


def test_long_and_short_segments_draw_alike(monkeypatch):
    vocab = sentence_pieces.Vocabulary.load()
    rng = random.Random(8)
    texts = [" " * rng.randint(0, 9) + "".join(rng.choice("etaoinsh") for _ in range(rng.randint(0, 40))) + "日本\n\n  x é" for _ in range(60)]
    buf = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    seeds = np.arange(len(texts), dtype=np.uint64) * np.uint64(31)
    ids, bounds = sentence_pieces.encode_slice(vocab, buf, off, seeds)
    assert b"".join(vocab.spelled[i] for i in ids.tolist()) == buf.tobytes()
    assert any(vocab.spelled[i].isspace() and len(vocab.spelled[i]) > 1 for i in ids.tolist())      # runs of blanks are pieces too
    monkeypatch.setattr(sentence_pieces, "_SLICE", 100)             # distinct segments in several parts
    few, same = sentence_pieces.encode_slice(vocab, buf, off, seeds)
    assert (few == ids).all() and (same == bounds).all()
    monkeypatch.setattr(sentence_pieces, "_LONG", 0)
    for block in (1 << 14, 30):
        monkeypatch.setattr(sentence_pieces, "_BLOCK", block)
        few, same = sentence_pieces.encode_slice(vocab, buf, off, seeds)
        assert (few == ids).all() and (same == bounds).all()


def test_text_without_blanks_costs_little_and_stays_lossless():
    vocab = sentence_pieces.Vocabulary.load()
    rng = random.Random(2)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "".join(chr(0x4e00 + i) for i in range(3000)), "z", " "):
        data = "".join(rng.choices(letters, k=60_000)).encode()
        buf = np.frombuffer(data, dtype=np.uint8)
        began = time.process_time()
        ids, _ = sentence_pieces.encode_slice(vocab, buf, np.array([0, len(data)]), np.array([7], dtype=np.uint64))
        assert (time.process_time() - began) / len(data) < 20e-6            # the sampler before took 60 to 90 us a byte
        assert b"".join(vocab.spelled[i] for i in ids.tolist()) == data
