"""The dealt operators against brute force on small tables with awkward rows."""

import base64
import math
import random
import re
import textwrap
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import (decontaminate, exact_dedup, jaccard_join, kd_sharding, language_id, license_scan, pii,
                         sentence_pieces, substring_dedup, url_filter)
from lectern.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, kept string, n int, h string, pieces string"
SPACE = " \t\n\r\x0b\x0c"


def awkward():
    """Nulls in every column, empty and very long texts, ties, repeated rows,
    and columns named like the operators' own."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Über", "ÉCOLE", "naïve", "日本", "x-y", "a.b"]
    def say(n):
        return " ".join(rng.choice(words) for _ in range(n))
    base = say(120)
    rows = [(i, say(rng.randint(1, 90)), "en", f"s{i % 3}", "k", i, "h", "p") for i in range(30)]
    for i in range(30, 42):                                 # near copies of one text
        w = base.split()
        for _ in range(i - 30):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w), "en", "s0", None, None, None, None))
    rows += [(50, None, None, None, None, None, None, None), (51, "", "en", "s", "k", 1, "h", "p"),
             (52, " \t\n ", "en", "s", "k", 1, "h", "p"), (None, "alone without id", "en", "s", "k", 1, "h", "p"),
             (None, base, None, "s", "k", 1, "h", "p"), (53, base.upper(), "en", "s", "k", 1, "h", "p"),
             (54, say(3), "en", "s", "k", 1, "h", "p"), (55, "w1 w2", "en", "s", "k", 1, "h", "p"),
             (56, "w1  w2", "en", "s", "k", 1, "h", "p"), (57, "a " * 4000, "en", "s", "k", 1, "h", "p"),
             (58, "y" * 60000, "en", "s", "k", 1, "h", "p"), (59, "\x00\x01 ▁ é\u0301 🎈", "en", "s", "k", 1, "h", "p"),
             (60, base, "en", "s", "k", 1, "h", "p"), (60, base, "en", "s", "k", 1, "h", "p"),
             (61, base, "en", "s", "k", 1, "h", "p")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_dedup(docs, empty):
    got = rows(exact_dedup.exact_dedup(docs).select("doc_id", "text", "keep_id", "group_size", "kept", "source"))
    groups = defaultdict(list)
    for r in awkward():
        groups[r[1] or ""].append(r[0])
    want = []
    for r in awkward():
        own = groups[r[1] or ""]
        keep = max((i for i in own if i is not None), default=None)
        want.append((r[0], r[1], keep, len(own), r[0] == keep, r[3]))
    assert got == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(empty).count() == 0


def brute_contamination(docs, items, window):
    tests = []
    for name, text in items:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        n = min(window, len(w))
        tests += [(w[i:i + n], name or "") for i in range(len(w) - n + 1 if n else 0)]
    out = []
    for i, text in docs:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        hit, names = set(), set()
        for t, name in tests:
            for p in range(len(w) - len(t) + 1):
                if w[p:p + len(t)] == t:
                    hit.update(range(p, p + len(t)))
                    names.add(name)
        out.append((i, len(w), len(hit), sorted(names), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, docs, empty, block_bytes):
    base = awkward()[30][1].split()
    items = [("a", " ".join(base[10:40])), ("b", " ".join(base[20:45])), ("c", "W1 w2"), ("c", "ÜBER"), ("d", None),
             ("e", "..."), (None, " ".join(base[60:75])), ("f", "nowhere to be found in any of these documents at all")]
    table = spark.createDataFrame(items, "item_id string, text string")
    got = decontaminate.find_contamination(docs, table, block_bytes=block_bytes)
    want = brute_contamination([(r[0], r[1]) for r in awkward()], items, 10)
    assert rows(got.select("doc_id", "n_words", "n_hit", "items", "contaminated")) == want
    longest = {r["doc_id"]: r["longest"] for r in got.collect()}
    assert longest[30] == 30                                        # the whole of item a, verbatim
    assert decontaminate.find_contamination(empty, table).count() == 0
    none = decontaminate.find_contamination(docs, table.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == docs.count()


def test_personal_data_base_spans_match_plain_patterns():
    plain = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                                     r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
                                     r"\+[0-9][\x20().0-9-]+[0-9]")]
    rng = random.Random(9)
    for _ in range(4000):
        text = "".join(rng.choice("ab1234567890@@..-+ ()%é") for _ in range(rng.randint(0, 90)))
        want = [(k, m.start(), m.end()) for k, p in enumerate(plain) for m in p.finditer(text)
                if pii.strict(pii.KINDS[k], m.group())]
        assert pii.base_spans(text) == want
    assert pii.base_spans("x" * 200_000 + "@" + "1" * 200_000) == []
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")


def test_personal_data(spark, empty):
    texts = ["mail a.b@c-d.org or 10.0.0.256 and 10.0.0.1", None, "", "card 4539 5787 6362 1486.",
             "call +49 (30) 123-4567 or call (212) 555-0199 today", "order 212-555-0199-77", "ssn 123-45-6789"] * 3
    d = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = pii.find_spans(d).withColumn("t", pii.spans_text(F.col("spans")))
    by = {r["doc_id"]: r["t"] for r in found.collect()}
    assert by[0] == "email:5:16,ip:35:43" and by[1] == by[2] == "" and by[3] == "card:5:24"
    assert by[4].startswith("phone:5:22") and "phone_local:31:45" in by[4]
    assert by[5] == "" and by[6] in ("", "id_number:4:15")
    hidden = d.join(found, "doc_id").select("doc_id", pii.redact(F.col("text"), found["spans"]).alias("r"))
    assert {r["doc_id"]: r["r"] for r in hidden.collect()}[0] == "mail <email> or 10.0.0.256 and <ip>"
    assert pii.find_spans(empty).count() == 0


def test_expectation_maximisation_tells_good_labelers_from_bad():
    rng = random.Random(2)
    patterns = defaultdict(int)
    for _ in range(5000):
        truth = rng.random() < 0.4
        right = (0.95, 0.9, 0.85, 0.6, 0.6, 0.9)
        v = tuple((1 if truth == (rng.random() < p) else -1) for p in right)
        patterns[pii._code(7, v)] += 1
    good, prior, post = pii.expectation_maximisation(dict(patterns))
    assert good[0].min() > 0.9 and good[3].max() < 0.7 and abs(prior[7] - 0.4) < 0.05
    model = pii.train(dict(patterns))
    assert model.probability(7, (1, 1, 1, 1, 1, 1)) > 0.95 > 0.05 > model.probability(7, (-1,) * 6)


def brute_components(docs, words, similar):
    sets = []
    for _, text in docs:
        w = words_of(lower(text))
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    label = list(range(len(docs)))
    def top(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j]):
                label[top(i)] = top(j)
    smallest = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        if d is not None:
            smallest[top(i)].append(d)
    return sorted(((d, len(s), min(smallest[top(i)], default=None)) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def test_jaccard_join(spark, docs, empty, monkeypatch):
    assert rows(jaccard_join.jaccard_components(docs)) == brute_components([(r[0], r[1]) for r in awkward()], 5, 80)
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_jaccard_join_without_pivots_uses_the_trees(spark, monkeypatch):
    """All links must come from the trees, in cells of three members a side."""
    monkeypatch.setattr(jaccard_join, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(jaccard_join, "CELL", 3)
    rng = random.Random(1)
    made = []
    for g in range(4):
        base = [f"g{g}w{rng.randrange(500)}" for _ in range(60)]
        for i in range(12):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(60)] = f"x{rng.randrange(9999)}"
            made.append((len(made), " ".join(w)))
    d = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    assert rows(jaccard_join.jaccard_components(d)) == brute_components(made, 5, 80)


def test_tree_pairs_lose_no_link():
    rng = random.Random(3)
    sets = []
    for g in range(6):
        base = {rng.getrandbits(64) for _ in range(rng.randint(5, 80))}
        for _ in range(8):
            keep = {h for h in base if rng.random() > 0.1} | {rng.getrandbits(64) for _ in range(rng.randrange(4))}
            sets.append(keep or {1})
    members = []
    for c, s in enumerate(sets):
        bits = jaccard_join.bitmap_bits(len(s))
        flags = np.zeros(bits, dtype=np.uint8)
        flags[[h % bits for h in s]] = 1
        members.append((0, c, len(s), c, np.packbits(flags, bitorder="little").tobytes(), [5, 7 + c % 2]))
    assert not jaccard_join._cell_pairs(7, members, 80)         # every pair has the earlier block 5 in common
    got = set(jaccard_join._cell_pairs(5, members, 80))
    want = {(i, j) for j in range(len(sets)) for i in range(j)
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert want <= got and len(got) < len(sets) * (len(sets) - 1) / 4


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def brute_repeats(docs, window):
    seen = defaultdict(int)
    for _, text in docs:
        w = words_of(text)
        for i in range(len(w) - window + 1):
            seen[tuple(w[i:i + window])] += 1
    out = []
    for d, text in docs:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [35, 12, 3])
def test_substring_dedup(docs, empty, window):
    got = substring_dedup.remove_repeats(docs, window=window)
    assert rows(got.select("doc_id", "n_words", "n_removed", "kept_text")) == \
        brute_repeats([(r[0], r[1]) for r in awkward()], window)
    for r in got.collect():                                     # intervals are maximal and in order
        assert all(a["end"] < b["start"] for a, b in zip(r["removed"], r["removed"][1:]))
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_licence_scan(spark, docs, empty):
    lines = ["All rights reserved.", "all RIGHTS, reserved", "Licensed under CC BY-NC 4.0.", "no licence here",
             "This work is licensed under the GNU General Public License, version 2", "rights reserved all"]
    made = [(i, t) for i, t in enumerate(lines)] + [(10, "\n".join(["intro text of a document", *lines[:1], ""])), (11, None), (12, "")]
    got = license_scan.scan_licences(spark.createDataFrame(made, "doc_id long, text string"))

    def grams(text):
        w = re.findall("[a-z0-9]+", lower(text))
        return set(w) if len(w) == 1 else set(zip(w, w[1:]))
    want = []
    for d, text in made:
        parts = (text or "").split("\n")
        for at, segment in [*enumerate(parts), *([(-1, text)] if len(parts) > 1 else [])]:
            best = min(((-2 * len(grams(segment) & grams(t)) / (len(grams(segment)) + len(grams(t))), name)
                        for name, t in license_scan.TEMPLATES if grams(segment)), default=(0, ""))
            if -best[0] >= license_scan.THRESHOLD:
                want.append((d, segment, best[1], -best[0], at))
    assert [r[:3] + (round(r[3], 9), r[4]) for r in rows(got)] == \
        [w[:3] + (round(w[3], 9), w[4]) for w in sorted(want, key=repr)]
    assert len(want) >= 5
    assert license_scan.scan_licences(docs).count() == 0 and license_scan.scan_licences(empty).count() == 0


def test_licence_scan_finds_notices_inside_lines_and_over_line_ends(spark):
    made = [(1, "This software is released under the MIT License, see the LICENSE file for details."),
            (2, "First line\nCopyright 2019 Acme Inc. All rights reserved. More words follow here."),
            (3, "Before it.\n# Licensed under the Apache\n# License, Version\n# 2.0 (the rest), as it says\nend"),
            (4, "Nothing is licensed here, and no rights are named."),
            (5, "All rights reserved.\nLater: the work is licensed under the BSD 3-Clause\nLicense. All\nRights Reserved, again."),
            (6, "\n".join(["some words of a longer text"] * 300) + "\nis licensed under CC BY\n4.0 and so on")]
    got = license_scan.scan_licences(spark.createDataFrame(made, "doc_id long, text string"))
    assert rows(got.select("doc_id", "licence", "start_line", "segment")) == [
        (1, "MIT", 0, "released under the MIT License"),
        (2, "All-Rights-Reserved", 1, "All rights reserved"),
        (3, "Apache-2.0", 1, "Licensed under the Apache\n# License, Version\n# 2.0"),
        (5, "All-Rights-Reserved", 0, "All rights reserved."),
        (5, "All-Rights-Reserved", 2, "All\nRights Reserved"),
        (5, "BSD-3-Clause", 1, "licensed under the BSD 3-Clause\nLicense"),
        (6, "CC-BY-4.0", 300, "licensed under CC BY\n4.0")]
    assert {r[0] for r in got.select(F.round("dice", 6)).collect()} == {1.0}


def test_licence_headers_texts_and_tags(spark):
    """Every template is found, wrapped and commented, with a holder's line before it."""
    known = list(dict.fromkeys(license_scan.TEMPLATES))
    assert {"LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "ISC", "BSD-2-Clause", "CC0-1.0", "Unlicense"} <= {k for k, _ in known}
    assert {"MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "BSD-2-Clause", "BSD-3-Clause"} <= {k for k, t in known if len(t) > 300}
    made = [(i, "# Copyright 2020 Somebody\n# " + "\n# ".join(textwrap.wrap(t, 60)) + "\nimport this\n") for i, (_, t) in enumerate(known)]
    got = license_scan.scan_licences(spark.createDataFrame(made, "doc_id long, text string")).toPandas()
    for i, (name, t) in enumerate(known):
        assert name in set(got[(got.doc_id == i) & (got.dice > 0.99)].licence), (name, t)


def test_licence_windows_are_all_found(spark):
    """A text has a match exactly where some window of its words reaches the threshold."""
    rng = random.Random(6)

    def grams(w):
        return set(zip(w, w[1:]))
    known = [re.findall("[a-z0-9]+", lower(t)) for _, t in license_scan.TEMPLATES]
    made = []
    for i in range(60):
        w = list(rng.choice([k for k in known if len(k) < 25]))
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(w + ["other"])
        if rng.random() < 0.5:
            w.insert(rng.randrange(len(w)), rng.choice(w))
        made.append((i, "start of it " + rng.choice([" ", "\n"]).join(w) + " and its end"))
    want = set()
    for d, text in made:
        w = text.split()
        if any(2 * len(grams(w[a:b]) & grams(k)) >= license_scan.THRESHOLD * (len(grams(w[a:b])) + len(grams(k)))
               for k in known for a in range(len(w)) for b in range(a + 2, len(w) + 1)
               if b - a - 1 <= len(grams(k)) * (2 - license_scan.THRESHOLD) / license_scan.THRESHOLD):
            want.add(d)
    got = license_scan.scan_licences(spark.createDataFrame(made, "doc_id long, text string"))
    assert {r["doc_id"] for r in got.collect()} == want and 10 < len(want) < 60


def test_kd_sharding(docs, empty):
    got = kd_sharding.shard_documents(docs, shards=4).toPandas()
    assert len(got) == docs.count()
    want = sorted((len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in awkward())
    assert sorted(zip(got["size"], got.text_crc32)) == want
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert kd_sharding.shard_documents(empty).count() == 0
    odd = kd_sharding.shard_documents(docs.filter("doc_id < 42"), target_bytes=1500).toPandas()
    sizes = odd.groupby("shard")["size"].sum()
    assert len(sizes) == math.ceil(odd["size"].sum() / 1500) and sizes.max() < 2.2 * sizes.mean()


def test_kd_sharding_splits_a_hot_group(spark):
    made = [(i, "same text" if i % 3 else f"text number {i} of many") for i in range(3000)]
    got = kd_sharding.shard_documents(spark.createDataFrame(made, "doc_id long, text string")).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 16 and sizes.max() < 1.1 * sizes.mean() and sizes.min() > 0.9 * sizes.mean()


def test_language_id(spark, docs, empty):
    de, en = "der die das und ist nicht ein schöner tag", "the and of is not that a beautiful day"
    rng = random.Random(4)
    made = [(i, " ".join(rng.sample((de if i % 2 else en).split(), 6)), "de" if i % 2 else "en") for i in range(120)]
    made += [(200, None, "en"), (201, "123 -- 456", "en"), (202, de, None), (203, "", None), (None, en, "en")]
    d = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = language_id.fit(d.filter("doc_id < 80"))
    got = {r["doc_id"]: r for r in language_id.identify(d, model).collect()}
    assert all(got[i]["lang_pred"] == ("de" if i % 2 else "en") for i in range(120))
    assert all(got[i]["lang_pred"] == "und" and got[i]["rejected"] and got[i]["score"] == 0 for i in (200, 201, 203))
    assert got[202]["lang_pred"] == "de" and got[None]["lang_pred"] == "en"
    far = language_id.identify(spark.createDataFrame([(1, "東京都渋谷区神南一丁目")], "doc_id long, text string"), model)
    assert far.first()["rejected"]
    assert language_id.fit(empty) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def test_language_id_rejects_other_languages_and_gibberish(spark):
    """One odd labelled text of a language must not let everything through."""
    rng = random.Random(8)
    abc = "abcdefghijklmnopqrstuvwxyz"
    far = [
        "Съешь ещё этих мягких французских булок, да выпей же чаю. Москва является столицей Российской Федерации.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "Suomen kieli kuuluu itämerensuomalaisiin kieliin. Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan.",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem.",
        "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。",
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
        "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق. وقد وهبوا عقلا وضميرا.",
        *(" ".join("".join(rng.choice(abc) for _ in range(rng.randint(2, 9))) for _ in range(n)) for n in (30, 120, 1000)),
        *(base64.b64encode(rng.randbytes(n)).decode() for n in (300, 3000)),
    ]
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "XKCD %% qqzx 77", "fr")], d.schema)
    model = language_id.fit(d.filter(~language_id.held_out(F.col("doc_id"))).unionByName(odd))
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(far)], "doc_id long, text string")
    assert [r["doc_id"] for r in language_id.identify(asked, model).filter("not rejected").collect()] == []
    assert language_id.identify(d.select("doc_id", "text"), model).filter("rejected").count() == 0


def test_language_sample_is_of_distinct_texts(spark):
    """A language of one text with many copies is learned, from one row."""
    made = [(f"the text of number {i} and more", "en") for i in range(40)] * 3
    made += [(f"ein Text {i} mit Wörtern", "de") for i in range(5)] + [("un texte que tout le monde copie", "fr")] * 2000
    d = spark.createDataFrame(made, "text string, lang string")
    got = language_id.distinct_sample(d, "text", "lang", 20).collect()
    assert len(set(got)) == len(got)
    assert {n: sum(r["lang"] == n for r in got) for n in ("en", "de", "fr")} == {"en": 20, "de": 5, "fr": 1}
    assert set(language_id.fit(d, sample=1).languages) == {"en", "de", "fr"}


def test_held_out_rule(spark):
    d = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    got = {r[0]: r[1] for r in d.select("doc_id", language_id.held_out(F.col("doc_id"))).collect()}
    assert got.pop(None) is False and got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)}


def test_sentence_pieces_round_trip(docs, empty):
    coded = sentence_pieces.encode(docs)
    out = sentence_pieces.decode(coded).select("doc_id", "text", "decoded", "pieces").collect()
    assert len(out) == docs.count()
    assert all(r["decoded"] == r["text"] for r in out)
    assert all((r["pieces"] is None) == (r["text"] is None) for r in out)
    again = sentence_pieces.encode(docs.repartition(5)).select("doc_id", "text", "pieces")
    assert rows(again) == rows(coded.select("doc_id", "text", "pieces"))
    other = sentence_pieces.encode(docs, seed=1).select("doc_id", "text", "pieces")
    assert rows(other) != rows(again)
    assert sentence_pieces.decode(sentence_pieces.encode(empty)).count() == 0


@pytest.mark.parametrize("longest", [48, 0])
def test_sampled_segmentations_follow_the_lattice(longest, monkeypatch):
    """Frequencies of all segmentations of a word against their exact weights."""
    monkeypatch.setattr(sentence_pieces, "_LONG", longest)
    vocab = sentence_pieces.Vocabulary.load()
    word = " their".encode()
    weights = {}
    def walk(at, path, log):
        if at == len(word):
            weights[tuple(path)] = math.exp(log)
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in vocab.pieces:
                w, i = vocab.pieces[word[at:end]]
                walk(end, [*path, i], log + w)
        walk(at + 1, [*path, int(vocab.byte_ids[word[at]])], log - 14.0) if at < len(word) else None
    walk(0, [], 0.0)
    n = 6000 if longest else 1500
    buf = np.frombuffer(word * n, dtype=np.uint8)
    off = np.arange(n + 1) * len(word)
    ids, bounds = sentence_pieces.encode_slice(vocab, buf, off, np.arange(n, dtype=np.uint64) * 977 + 5)
    seen = defaultdict(int)
    for a, b in zip(bounds[:-1], bounds[1:]):
        seen[tuple(ids[a:b].tolist())] += 1
    total = sum(weights.values())
    assert set(seen) <= set(weights)
    for path, w in sorted(weights.items(), key=lambda x: -x[1])[:6]:
        p = w / total
        assert abs(seen[path] / n - p) < 4 * math.sqrt(p * (1 - p) / n) + 0.002


def test_url_filter(spark):
    urls = ["http://A.Example.ORG/en/5?x=1", "https://example.org/es/9", "http://sub.example.org/en/17#f", "http://example.com/de/1",
            "http://example.com/fr/2", "no scheme", None, "", "http://Org", "ftp://x.net/a://b", "http://notexample.org/es/1",
            "http://h?q=/org/", "http://é.com/fr/\n"] * 4
    made = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(made).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (lower(m[1]), m[2]) if m else ("", "")
        fits = [r for r, _ in url_filter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith("/" + r.split("/", 1)[1])]
        rule = max(fits, key=len, default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        if rule:
            assert got[i]["verdict"] == dict(url_filter.RULES)[rule]
        assert got[i]["verdict"] in ("allow", "block")
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(none).count() == 0
    one = url_filter.judge_urls(made.filter("page_id = 0 or page_id = 5"))
    assert {r["verdict"] for r in one.collect()} == {"allow"}




def test_languages_are_learned_from_all_distinct_texts(spark):
    """No text is left out: words that few of many texts hold still shape a centroid."""
    made = [(f"{'abc def' if i % 500 else 'zzqx vvkj'} {i} words of this", "en") for i in range(2500)]
    made += [(f"ein Text {i} mit Wörtern", "de") for i in range(50)] + [("ein Text 1 mit Wörtern", "de")] * 500
    rows = spark.createDataFrame(made, "text string, lang string").repartition(3)
    seen = []
    for fn in ("_centroids", "_floors"):
        kept = getattr(language_id, fn)
        setattr(language_id, fn, lambda packed, *a, kept=kept: (seen.append(packed.groupBy("lang").count().collect()), kept(packed, *a))[1])
        try:
            model = language_id.fit(rows)
        finally:
            setattr(language_id, fn, kept)
    assert [{r["lang"]: r["count"] for r in got} for got in seen] == [{"en": 2500, "de": 50}] * 2
    assert set(model.languages) == {"en", "de"} and model.floors.shape == (len(model.languages), language_id.SIZES)
    got = {r["lang"]: r["lang_pred"] for r in language_id.identify(rows, model).collect()}
    assert got == {"en": "en", "de": "de"}
