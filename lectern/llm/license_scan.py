"""Licence scans: Dice coefficient over word bigrams, DataFrame functions only.

Texts are normalised to words of lower-case letters and digits. Compared with a
template, by the Dice coefficient of their sets of word bigrams,
2 |A n B| / (|A| + |B|), are every non-blank line, the whole text, and windows
of neighbouring words that slide over the whole text across line ends. A
coefficient of t needs t / (2 - t) of the template's bigrams and at most
(2 - t) / t times as many, which bounds the windows. It also gives each template
a few words of which one must occur, and a part of its words that must: a
text that lacks them for every template is dropped before its words are cut. A window begins and ends with a bigram of the
template, since any other edge only lowers the coefficient.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import prepare

THRESHOLD = 0.8

#: Licence notices, headers, texts and tags, (licence id, text).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("All-Rights-Reserved", "All rights reserved."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Licensed under the ISC License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    # standard headers, and whole texts where they are short
    ("MIT", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        'without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell '
        'copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the '
        'following conditions: The above copyright notice and this permission notice shall be included in all '
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY '
        'KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A '
        'PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR '
        'ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, '
        'OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
    )),
    ("ISC", (
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is '
        'hereby granted, provided that the above copyright notice and this permission notice appear in all copies. '
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        'INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE '
        'FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS '
        'OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING '
        'OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
    )),
    ("BSD-2-Clause", (
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided '
        'that the following conditions are met: 1. Redistributions of source code must retain the above copyright '
        'notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must '
        'reproduce the above copyright notice, this list of conditions and the following disclaimer in the '
        'documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE '
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        'LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE '
        'DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, '
        'INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF '
        'SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND '
        'ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR '
        'OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH '
        'DAMAGE.'
    )),
    ("BSD-3-Clause", (
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided '
        'that the following conditions are met: 1. Redistributions of source code must retain the above copyright '
        'notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must '
        'reproduce the above copyright notice, this list of conditions and the following disclaimer in the '
        'documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright '
        'holder nor the names of its contributors may be used to endorse or promote products derived from this '
        'software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS '
        'AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
        'IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT '
        'SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, '
        'EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR '
        'SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF '
        'LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN '
        'ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
    )),
    ("Apache-2.0", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        'compliance with the License. You may obtain a copy of the License at '
        'http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, '
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        'CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing '
        'permissions and limitations under the License.'
    )),
    ("GPL-2.0", (
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation; either version 2 of the License, or '
        '(at your option) any later version. This program is distributed in the hope that it will be useful, but '
        'WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR '
        'PURPOSE. See the GNU General Public License for more details.'
    )),
    ("GPL-3.0", (
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU '
        'General Public License as published by the Free Software Foundation; either version 3 of the License, or '
        '(at your option) any later version. This program is distributed in the hope that it will be useful, but '
        'WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR '
        'PURPOSE. See the GNU General Public License for more details.'
    )),
    ("LGPL-2.1", (
        'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser '
        'General Public License as published by the Free Software Foundation; either version 2.1 of the License, '
        'or (at your option) any later version. This library is distributed in the hope that it will be useful, '
        'but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A '
        'PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.'
    )),
    ("LGPL-3.0", (
        'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser '
        'General Public License as published by the Free Software Foundation; either version 3 of the License, or '
        '(at your option) any later version. This library is distributed in the hope that it will be useful, but '
        'WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR '
        'PURPOSE. See the GNU Lesser General Public License for more details.'
    )),
    ("AGPL-3.0", (
        'This program is free software; you can redistribute it and/or modify it under the terms of the GNU Affero '
        'General Public License as published by the Free Software Foundation; either version 3 of the License, or '
        '(at your option) any later version. This program is distributed in the hope that it will be useful, but '
        'WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR '
        'PURPOSE. See the GNU Affero General Public License for more details.'
    )),
    ("MPL-2.0", (
        'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL '
        'was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.'
    )),
    ("CC0-1.0", (
        'To the extent possible under law, the author has waived all copyright and related or neighboring rights '
        'to this work.'
    )),
    ("Unlicense", (
        'This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, '
        'publish, use, compile, sell, or distribute this software, either in source code form or as a compiled '
        'binary, for any purpose, commercial or non-commercial, and by any means.'
    )),
    # tags of source files; the licence is named without -only and -or-later
    *((name.removesuffix("-only").removesuffix("-or-later"), "SPDX-License-Identifier: " + name) for name in (
            "MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
            "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
            "AGPL-3.0-or-later", "MPL-2.0", "ISC", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0",
            "CC-BY-SA-4.0", "CC-BY-NC-4.0", "Unlicense",)),
)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Runs of letters and digits of ASCII, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit("[a-z0-9]+"), F.lit(0))


def bigrams_of(words: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is its own pair."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(n - 1, F.lit(0))),
                       F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(n == 1, words).otherwise(pairs))


def _templates(spark, templates) -> list:
    """(licence, template, words, grams). Repeated templates are one."""
    t = spark.createDataFrame(list(dict.fromkeys(templates)), "licence string, template string")
    return (t.withColumn("words", words_of(F.col("template"))).withColumn("grams", bigrams_of(F.col("words")))
            .filter(F.size("grams") > 0).collect())         # as many rows as templates are given


def _need(size: int, threshold: float) -> int:
    """How many of a template's bigrams a match shares with it, at least."""
    return max(1, math.ceil(size * threshold / (2 - threshold) - 1e-9))


def _most(size: int, threshold: float) -> int:
    """How many bigrams a match has, at most."""
    return math.floor(size * (2 - threshold) / threshold + 1e-9)


def key_words(known: list, threshold: float) -> list[list[str]]:
    """Words per template of which every match has one: too few of the template's
    bigrams are without them. Long words first, they are rare."""
    out, used = [], set()
    for t in known:
        keys, left = [], set(t["grams"])
        while len(left) >= _need(len(t["grams"]), threshold):
            cover = {w: sum(w in g.split() for g in left) for w in t["words"]}
            best = min((w for w in cover if cover[w]),
                       key=lambda w: (len(w) < 4, len(w) < 6 and w not in used, -cover[w], w not in used, -len(w), w))
            keys.append(best)
            left = {g for g in left if best not in g.split()}
        used.update(keys)
        out.append(keys)
    return out


def telling_words(known: list, threshold: float, long: int = 6, short: int = 16) -> list[tuple[list[tuple[str, int]], int]]:
    """Per template its words (of a template of more than ``short`` those of ``long``
    letters), each with the number of bigrams that it is in, and the sum of these
    numbers that the words of a matching text reach.

    A match lacks few of the template's bigrams, a word that is absent takes all
    of its own with it, and a bigram has two words at most."""
    out = []
    for t in known:
        least = long if len(t["words"]) > short else 1
        degree = {w: sum(w in g.split() for g in t["grams"]) for w in dict.fromkeys(t["words"]) if len(w) >= least}
        slack = len(t["grams"]) - _need(len(t["grams"]), threshold)
        out.append((list(degree.items()), max(0, sum(degree.values()) - 2 * slack)))
    return out


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once a row, whatever reads them later.
    (A projection may be merged into what is above it, a generator not.)"""
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.withColumn("__once", F.explode_outer(F.array(made))).select(
        *df.columns, *[F.col(f"__once.{name}").alias(name) for name in columns])


def _dice(own: Column, grams: Column) -> Column:
    return F.lit(2.0) * F.size(F.array_intersect(own, grams)) / (F.size(F.array_distinct(own)) + F.size(grams))


def _best(grams: Column, templates: Column, threshold: float) -> Column:
    """(rank, licence, template) of the nearest template, null below the threshold."""
    n = F.size(grams)

    def score(t):
        return F.when((n >= t["need"]) & (n <= t["most"]),
                      F.struct((-_dice(grams, t["grams"])).alias("rank"), t["licence"].alias("licence"),
                               t["template"].alias("template")))
    best = F.array_min(F.transform(templates, score))
    return F.when(-best["rank"] >= F.lit(threshold), best)


def _windows(grams: Column, t: Column, threshold: float) -> Column:
    """Of each place where a match with the template ``t`` begins, the best:
    (rank, longer, licence, template, first, last), bigrams counted from 0."""
    hits = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i)), lambda i: i.isNotNull())

    def from_place(h, first, k):
        ends = F.filter(F.slice(h, k + t["need"], t["most"]), lambda last: last - first < t["most"])
        return F.array_min(F.transform(ends, lambda last: F.struct(
            (-_dice(F.slice(grams, first + 1, last - first + 1), t["grams"])).alias("rank"),
            (first - last).alias("longer"), t["licence"].alias("licence"), t["template"].alias("template"),
            first.alias("first"), last.alias("last"))))
    found = F.transform(F.array(hits), lambda h: F.transform(h, lambda first, k: from_place(h, first, k)))[0]
    return F.filter(found, lambda w: w.isNotNull() & (-w["rank"] >= F.lit(threshold)))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(id, segment, licence, dice, start_line): one row per matching segment.

    ``segment`` is the segment's text, ``start_line`` the line where it begins
    (0-based; -1 for a whole text of several lines); of several templates the
    highest Dice wins, ties by licence and template. Every matching line and
    whole text is a row. Windows are taken by falling Dice (ties: the longer,
    then by licence, template and place) where they overlap no window taken
    before and no matching line or whole text of at least that Dice. Null,
    empty and wordless texts match nothing. Repeated rows give repeated matches;
    other columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = _templates(spark, templates)
    base = docs.select(id_col, F.col(text_col).alias("__text"))
    kind = ("array<struct<licence:string,template:string,grams:array<string>,need:int,most:int,keys:array<string>,"
            "words:array<struct<word:string,degree:int>>,least:int>>")
    table = F.array(*[F.struct(
        F.lit(t["licence"]).alias("licence"), F.lit(t["template"]).alias("template"),
        F.array(*map(F.lit, t["grams"])).alias("grams"), F.lit(_need(len(t["grams"]), threshold)).alias("need"),
        F.lit(_most(len(t["grams"]), threshold)).alias("most"), F.array(*map(F.lit, keys)).alias("keys"),
        F.array(*[F.struct(F.lit(w).alias("word"), F.lit(d).alias("degree")) for w, d in words]).cast(
            "array<struct<word:string,degree:int>>").alias("words"), F.lit(least).alias("least"))
        for t, keys, (words, least) in zip(known, key_words(known, threshold), telling_words(known, threshold))]).cast(kind)
    # lower() also changes letters outside ASCII, so no text that has a key word is lost
    base = _once(base, __lower=F.lower("__text"))
    some = F.lit(False)
    for key in sorted({k for keys in key_words(known, threshold) for k in keys}):
        some = some | F.contains(F.col("__lower"), F.lit(key))
    base = base.filter(some)
    text, lines = F.col("__text"), F.split(F.col("__text"), "\n")
    def may_match(t):
        found = F.aggregate(t["words"], F.lit(0), lambda n, x: n + F.when(F.contains(F.col("__lower"), x["word"]), x["degree"]).otherwise(0))
        return F.exists(t["keys"], lambda k: F.contains(F.col("__lower"), k)) & (found >= t["least"])
    base = _once(base, __templates=F.filter(table, may_match)).filter(F.size("__templates") > 0)
    base = _once(base, __words=words_of(text), __lines=lines).drop("__lower")
    t = F.col("__templates")
    keys = F.flatten(F.transform(t, lambda x: x["keys"]))
    base = _once(base, __grams=F.zip_with(     # in order and with repeats; a single word is its own pair
        F.when(F.size("__words") == 1, F.col("__words")).otherwise(F.slice("__words", F.lit(1), F.greatest(F.size("__words") - 1, F.lit(0)))),
        F.slice("__words", F.lit(2), F.greatest(F.size("__words") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)),
        __keys=F.array_distinct(keys), __most=F.array_max(F.transform(t, lambda x: x["most"])))
    segments = F.transform("__lines", lambda s, i: F.struct(s.alias("segment"), i.alias("start_line")))
    segments = F.filter(segments, lambda s: F.exists("__keys", lambda k: F.contains(F.lower(s["segment"]), k)))
    segments = F.transform(segments, lambda s: F.struct(
        s["segment"].alias("segment"), s["start_line"].alias("start_line"), bigrams_of(words_of(s["segment"])).alias("grams")))
    whole = F.array_distinct("__grams")
    segments = F.concat(segments, F.when((F.size("__lines") > 1) & (F.size(whole) <= F.col("__most")), F.array(
        F.struct(text.alias("segment"), F.lit(-1).alias("start_line"), whole.alias("grams")))).otherwise(F.slice(segments, 1, 0)))
    base = _once(base, __segments=segments, __windows=F.flatten(F.transform(t, lambda x: _windows(F.col("__grams"), x, threshold))))
    # windows by rank; a window that overlaps one taken before goes
    row = "array<struct<rank:double,longer:int,licence:string,template:string,first:int,last:int>>"
    taken = F.aggregate(F.array_sort("__windows"), F.array().cast(row), lambda got, w: F.when(
        F.exists(got, lambda g: (w["first"] <= g["last"] + 1) & (g["first"] <= w["last"] + 1)), got).otherwise(
            F.concat(got, F.array(w))))
    matched = F.filter(F.transform("__segments", lambda s: F.struct(
        s["segment"].alias("segment"), s["start_line"].alias("start_line"), _best(s["grams"], t, threshold).alias("best"))),
        lambda s: s["best"].isNotNull())
    base = _once(base, __matched=matched, __taken=taken)
    # words with what is before the next one, for the text and the lines of a window
    raw = F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+[^A-Za-z0-9]*"), F.lit(0))
    start = F.regexp_extract(text, "^[^A-Za-z0-9]*", 0)
    base = _once(base, __raw=F.when(F.size("__taken") > 0, raw).otherwise(F.array().cast("array<string>")),
                 __start=F.when(F.size("__taken") > 0, start).otherwise(F.lit("")))

    def breaks(s):
        return F.length(s) - F.length(F.replace(s, F.lit("\n"), F.lit("")))

    def window(w):
        # bigrams first to last are the words first to last + 1; a text of one word has one bigram
        part = F.array_join(F.slice("__raw", w["first"] + 1, w["last"] - w["first"] + 2), "")
        return F.struct(F.regexp_replace(part, "[^A-Za-z0-9]+$", "").alias("segment"), w["rank"].alias("rank"),
                        w["licence"].alias("licence"),
                        breaks(F.concat(F.col("__start"), F.array_join(F.slice("__raw", F.lit(1), w["first"]), ""))).alias("line"))
    spans = F.filter(F.transform("__taken", window), lambda w: ~F.exists("__matched", lambda m: (
        (m["best"]["rank"] <= w["rank"]) & ((m["start_line"] < 0) | (m["start_line"] >= w["line"])
                                            & (m["start_line"] <= w["line"] + breaks(w["segment"]))))))
    out = F.concat(
        F.transform("__matched", lambda m: F.struct(m["segment"].alias("segment"), m["best"]["licence"].alias("licence"),
                                                    (-m["best"]["rank"]).alias("dice"), m["start_line"].alias("start_line"))),
        F.transform(spans, lambda w: F.struct(w["segment"].alias("segment"), w["licence"].alias("licence"),
                                              (-w["rank"]).alias("dice"), w["line"].alias("start_line"))))
    return (base.select(id_col, F.explode_outer(out).alias("s")).filter("s is not null")
            .select(id_col, "s.segment", "s.licence", "s.dice", "s.start_line"))
