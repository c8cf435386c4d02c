import math
import random
from collections import Counter

import pytest

from lectern.functions.tokens import py_tokens
from lectern.operators import bm25 as BM
from lectern.operators import tone as TN
from lectern.plans.quote_search import quote_search


def plain_score(query, text, units):
    cut = [py_tokens(u) for u in units]
    df = Counter(t for u in cut for t in set(u))
    mean = sum(map(len, cut)) / len(cut)
    words = py_tokens(text)
    shared = sorted(set(py_tokens(query)) & set(words))
    score = 0.0
    for t in shared:
        tf = words.count(t)
        idf = math.log(1 + (len(cut) - df[t] + 0.5) / (df[t] + 0.5))
        score += idf * tf * (BM.K1 + 1) / (tf + BM.K1 * (1 - BM.B + BM.B * len(words) / mean))
    if len(shared) < 2:
        return round(score, 6)
    spans = [n for n in range(1, len(words) + 1) for i in range(len(words) - n + 1) if set(shared) <= set(words[i:i + n])]
    return round(score * (1 + len(shared) / min(spans)), 6)


def test_scores_against_plain_python(spark):
    rng = random.Random(4)
    vocabulary = ["ab", "cd", "Ef", "gh", "été", "日本", "x1"]
    def say(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))
    units = [say(rng.randint(0, 12)) for _ in range(30)] + ["", "..."]
    queries = [(0, "ab cd"), (1, "Gh, gh été!"), (2, "nowhere"), (3, "..."), (4, "日本 x1 ab ef AB")]
    windows = [(q, i, say(rng.randint(0, 9))) for q, _ in queries for i in range(12)]
    windows += [(0, 90, None), (4, 91, ""), (77, 92, "ab cd")]                   # null, empty, a query that is not there
    stats = BM.corpus_statistics(spark.createDataFrame([(u,) for u in units] + [(None,)], "text string"))
    got = BM.score_bm25(spark.createDataFrame(windows, "query_id long, w long, text string"),
                        spark.createDataFrame(queries, "query_id long, query string"), stats)
    assert got.columns == ["query_id", "w", "text", "score"]
    by = {(r.query_id, r.w): r.score for r in got.collect()}
    assert len(by) == len(windows) and by[(77, 92)] == 0.0
    for q, i, text in windows:
        if q != 77:
            want = plain_score(dict(queries)[q], text or "", [*units, ""])
            assert by[(q, i)] == pytest.approx(want, abs=2e-6), (q, text)


def test_words_that_stand_together_score_more(spark):
    stats = BM.corpus_statistics(spark.createDataFrame([("red fox and blue hen",), ("one two",)], "text string"))
    pairs = spark.createDataFrame([(1, "red fox a b c d"), (1, "red a b c d fox")], "query_id long, text string")
    near, far = BM.score_bm25(pairs, spark.createDataFrame([(1, "red fox")], "query_id long, query string"), stats).collect()
    assert near.score > far.score > 0


def test_statistics_of_nothing(spark):
    stats = BM.corpus_statistics(spark.createDataFrame([], "text string"))
    pairs = spark.createDataFrame([(1, "a b")], "query_id long, text string")
    assert BM.score_bm25(pairs, spark.createDataFrame([(1, "a")], "query_id long, query string"), stats).first().score > 0
    with pytest.raises(ValueError):
        quote_search(pairs, pairs, pairs, statistics=stats, scorer_factory=dict)


SEEDS = {"warm": ("sun", "heat"), "cold": ("ice",)}


def plain_words(texts, per_label, least, chars):
    cut = [set(py_tokens(t or "")) for t in texts]
    out = []
    for label, seeds in SEEDS.items():
        inside = [bool(u & set(seeds)) for u in cut]
        n, n_in = len(cut), sum(inside)
        rows = []
        for w in set().union(*cut) - {s for x in SEEDS.values() for s in x}:
            n_w, both = sum(w in u for u in cut), sum(w in u and f for u, f in zip(cut, inside))
            score = round(math.log((both + 1) / (n_in + 2)) - math.log((n_w - both + 1) / (n - n_in + 2)), 6)
            if both >= least and len(w) >= chars and score > 0:
                rows.append((-score, w.encode(), w, both))
        out += [(label, w, both, -s, r) for r, (s, _, w, both) in enumerate(sorted(rows)[:per_label], 1)]
    return sorted(out)


@pytest.mark.parametrize("per_label, least, chars", [(3, 2, 3), (50, 1, 1), (2, 40, 3)])
def test_learned_words_against_plain_python(spark, per_label, least, chars):
    rng = random.Random(6)
    warm, cold, other = ["sun", "beach", "sand", "heat", "summer"], ["ice", "snow", "frost", "été"], ["and", "the", "of", "q"]
    texts = [" ".join(rng.choice(rng.choice([warm, other])) for _ in range(6)) for _ in range(60)]
    texts += [" ".join(rng.choice(rng.choice([cold, other])) for _ in range(6)) for _ in range(60)] + [None, "", "Sun SUN"]
    windows = spark.createDataFrame([(t, 1) for t in texts], "text string, label int").repartition(7)
    got = TN.learn_tone_words(windows, SEEDS, per_label, least, chars)
    rows = sorted((r.label, r.word, r.n_windows, r.score, r["rank"]) for r in got.collect())
    assert rows == (
        plain_words(texts, per_label, least, chars))
    lexicon = TN.learned_lexicon(got, SEEDS)
    assert set(SEEDS["warm"]) <= set(lexicon["warm"]) and list(lexicon) == list(SEEDS)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "text string")
    got = TN.learn_tone_words(none, SEEDS)
    assert got.count() == 0 and TN.learned_lexicon(got, SEEDS)["cold"] == ("ice",)
    with pytest.raises(ValueError):
        TN.learn_tone_words(none, {"warm": ()})
