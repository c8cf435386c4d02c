"""Language identification by nearest centroid over byte n-grams.

A text is a vector of byte bigrams and trigrams (A-Z lower-cased, every other
ASCII character that is no letter a blank), hashed to a fixed number of
buckets, weighted by 1 + log tf and the inverse document frequency and brought
to length 1. Each language has several centroids, found by spherical k-means
over all distinct texts; a text gets the language of the nearest one by cosine. It
is rejected where its cosine is below a floor of that language for texts of its
size (the power of two of its distinct n-grams, since short texts are far from
every centroid): a share of a low quantile of the texts' cosines, so that no
single odd text sets it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import wordhash as W
from lectern.llm.common import lean, prepare, shared_table, text_slices

UNKNOWN = "und"
BUCKETS = 2048
CENTROIDS = 4              # per language
ROUNDS = 10
MARGIN = 0.5               # rejected below this share of the low quantile of the texts' cosines
LOW = 0.05                 # that quantile
LEAST = 30                 # cosines that a quantile is taken from, at least
SIZES = BUCKETS.bit_length()    # classes of texts by the power of two of their distinct n-grams
_ROWS = 256                # texts whose vectors are held at once

_FOLD = W.LOWER.copy()
_FOLD[:128][~(((np.arange(128) >= 65) & (np.arange(128) <= 90)) | ((np.arange(128) >= 97) & (np.arange(128) <= 122)))] = 32


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]       # of each centroid
    centroids: np.ndarray
    floors: np.ndarray         # of each centroid and size class, the cosine below which a text is rejected


def term_counts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """n-gram counts of each text, (texts, BUCKETS)."""
    n = len(off) - 1
    c = _FOLD[buf].astype(np.uint64)
    text = np.repeat(np.arange(n), np.diff(off))
    out = np.zeros(n * BUCKETS)
    for size in (2, 3):
        if len(c) < size:
            continue
        code = np.zeros(len(c) - size + 1, dtype=np.uint64)
        letters = np.zeros(len(code), dtype=bool)
        for j in range(size):
            code = code * np.uint64(256) + c[j:len(c) - size + 1 + j]
            letters |= c[j:len(c) - size + 1 + j] != 32
        keep = letters & (text[:len(code)] == text[size - 1:])
        slot = (W.mix(code[keep] + np.uint64(size << 32)) & np.uint64(BUCKETS - 1)).astype(np.int64)
        out += np.bincount(text[:len(code)][keep] * BUCKETS + slot, minlength=len(out))
    return out.reshape(n, BUCKETS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.where(counts > 0, 1.0 + np.log(np.maximum(counts, 1.0)), 0.0) * idf
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return (v / np.maximum(length, 1e-12)).astype(np.float32)


def size_classes(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((counts > 0).sum(axis=1), 1)).astype(np.int32)


def _groups(batches, text_col: str):
    """(batch, first row, past the last row, counts) for few texts at a time."""
    for batch in batches:
        for lo, hi, buf, off in text_slices(batch, text_col):
            for a in range(0, hi - lo, _ROWS):
                b = min(a + _ROWS, hi - lo)
                yield batch, lo + a, lo + b, term_counts(buf[off[a]:off[b]], off[a:b + 1] - off[a])


def _document_frequency(text_col: str):
    def run(batches):
        df, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for _, lo, hi, counts in _groups(batches, text_col):
            df += (counts > 0).sum(axis=0)
            n += hi - lo
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(np.arange(BUCKETS), -1)), pa.array(np.append(df, n))], ["slot", "n"])
    return run


def _packed(text_col: str, lang_col: str):
    """(lang, h, which, few, many): the n-gram counts of a text, packed: a bit a
    bucket, a byte for each that occurs, and in full those that a byte cannot hold."""
    def run(batches):
        for batch, lo, hi, counts in _groups(batches, text_col):
            rows = np.flatnonzero((counts > 0).any(axis=1))
            which = np.packbits(counts[rows] > 0, axis=1)
            own = [c[c > 0] for c in counts[rows]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(lang_col)[lo:hi].take(pa.array(rows)), batch.column("__h")[lo:hi].take(pa.array(rows)),
                 pa.array([w.tobytes() for w in which], pa.binary()),
                 pa.array([np.minimum(c, 255).astype(np.uint8).tobytes() for c in own], pa.binary()),
                 pa.array([c[c >= 255].astype(np.uint32).tobytes() for c in own], pa.binary())],
                ["lang", "h", "which", "few", "many"])
    return run


def _unpacked(batches, idf: np.ndarray):
    """(batch, vectors, size classes) of packed counts, some rows at a time."""
    for whole in batches:
        for lo in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(lo, _ROWS)
            flat = {c: b"".join(batch.column(c).to_pylist()) for c in ("which", "few", "many")}
            mask = np.unpackbits(np.frombuffer(flat["which"], np.uint8).reshape(batch.num_rows, -1), axis=1).astype(bool)
            n = np.frombuffer(flat["few"], np.uint8).astype(np.float64)
            n[n == 255] = np.frombuffer(flat["many"], np.uint32)
            counts = np.zeros(mask.shape)
            counts[mask] = n
            yield batch, vectors(counts, idf), size_classes(counts)


def _by_language(langs: pa.Array):
    langs = np.array(langs.to_pylist(), dtype=object)
    for lang in sorted(set(langs)):
        yield lang, np.flatnonzero(langs == lang)


def _sums(model_bc):
    """(lang, j, n, total): a task's vectors summed by nearest centroid of their
    language, or all under 0 where it has none yet."""
    def run(batches):
        idf, centroids = model_bc.value
        total, n = {}, {}
        for batch, x, _ in _unpacked(batches, idf):
            for lang, rows in _by_language(batch.column("lang")):
                c = centroids.get(lang)
                own = (x[rows] @ c.T).argmax(axis=1) if c is not None else np.zeros(len(rows), dtype=np.int64)
                for j in np.unique(own).tolist():
                    some = x[rows[own == j]].sum(axis=0, dtype=np.float64)
                    total[lang, j] = total[lang, j] + some if (lang, j) in total else some
                    n[lang, j] = n.get((lang, j), 0) + int((own == j).sum())
        yield from _sum_rows(total, n)
    return run


def _sum_rows(total: dict, n: dict):
    if total:
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([n[k] for k in keys], pa.int64()), pa.array([total[k] for k in keys], pa.list_(pa.float64()))],
            ["lang", "j", "n", "total"])


def _merged(batches):
    total, n = {}, {}
    for batch in batches:
        for lang, j, k, v in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            v = v.values.to_numpy(zero_copy_only=False)
            total[lang, j] = total[lang, j] + v if (lang, j) in total else v.copy()
            n[lang, j] = n.get((lang, j), 0) + k
    yield from _sum_rows(total, n)


def _farthest(model_bc):
    """(lang, near, h, v): of a task and language, the vector that is farthest from the seeds."""
    def run(batches):
        idf, seeds = model_bc.value
        best = {}
        for batch, x, _ in _unpacked(batches, idf):
            h = batch.column("h").to_numpy()
            for lang, rows in _by_language(batch.column("lang")):
                near = np.round((x[rows] @ seeds[lang].T).max(axis=1).astype(np.float64), 6)
                at = np.lexsort((h[rows], near))[0]
                if lang not in best or (near[at], h[rows[at]]) < best[lang][:2]:
                    best[lang] = (near[at], h[rows[at]], x[rows[at]])
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.string()), pa.array([b[0] for b in best.values()], pa.float64()),
                 pa.array([b[1] for b in best.values()], pa.int64()), pa.array([b[2] for b in best.values()], pa.list_(pa.float32()))],
                ["lang", "near", "h", "v"])
    return run


def _centroids(packed: DataFrame, idf: np.ndarray, k: int, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Spherical k-means of each language over all its texts, a pass a round; seeds
    are chosen farthest first from the mean. A few vectors a language reach the driver."""
    sc = packed.sparkSession.sparkContext

    def passed(fn, state, schema, merge):
        shared = sc.broadcast((idf, state))
        out = merge(packed.mapInArrow(lean(fn(shared)), schema)).collect()
        shared.destroy()
        return out

    def sums(state):
        return passed(_sums, state, _SUM_ROWS, lambda d: d.repartition("lang", "j").mapInArrow(lean(_merged), _SUM_ROWS))
    every = sums({})
    seeds = {r["lang"]: np.array([r["total"]]) / r["n"] for r in every}
    n = {r["lang"]: r["n"] for r in every}
    for _ in range(min(k, max(n.values(), default=0))):
        for r in passed(_farthest, seeds, "lang string, near double, h long, v array<float>",
                        lambda d: d.groupBy("lang").agg(F.min_by("v", F.struct("near", "h")).alias("v"))):
            if len(seeds[r["lang"]]) <= n[r["lang"]]:
                seeds[r["lang"]] = np.vstack([seeds[r["lang"]], np.array(r["v"])])
    found = {lang: v[1:] for lang, v in seeds.items()}
    for _ in range(rounds if found else 0):
        for r in sums(found):
            found[r["lang"]][r["j"]] = r["total"]
        found = {lang: c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12) for lang, c in found.items()}
    return found


_SUM_ROWS = "lang string, j int, n long, total array<double>"
_SEEN = "lang string, h long, cut int, size int, cosine double"


def _seen_rows(langs, h, cut, size, cosine) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(h, pa.int64()), pa.array([cut] * len(h), pa.int32()),
         pa.array(size, pa.int32()), pa.array(cosine, pa.float64())], ["lang", "h", "cut", "size", "cosine"])


def _cosines(model_bc):
    """How near texts are to the nearest centroid of their own language."""
    def run(batches):
        idf, own = model_bc.value
        for batch, x, size in _unpacked(batches, idf):
            h = batch.column("h").to_numpy()
            for lang, rows in _by_language(batch.column("lang")):
                yield _seen_rows([lang] * len(rows), h[rows], 0, size[rows], (x[rows] @ own[lang].T).max(axis=1).astype(np.float64))
    return run


def _head_cosines(model_bc, text_col: str, lang_col: str):
    """The same of the first 8, 16, 32, ... bytes of longer texts, for the size
    classes of a language that have too few texts."""
    def run(batches):
        idf, own, few = model_bc.value
        for batch in batches:
            for lo, hi, buf, off in text_slices(batch, text_col):
                for a in range(0, hi - lo, _ROWS):
                    b = min(a + _ROWS, hi - lo)
                    langs = batch.column(lang_col)[lo + a:lo + b].to_pylist()
                    h = batch.column("__h")[lo + a:lo + b].to_numpy()
                    last = np.array([max(few.get(x, ()), default=-1) for x in langs])
                    length, cut = np.diff(off[a:b + 1]), 8
                    rows = np.flatnonzero((length > cut) & (last >= 0))
                    while len(rows):
                        heads = buf[(off[a + rows][:, None] + np.arange(cut)).reshape(-1)]
                        counts = term_counts(heads, np.arange(len(rows) + 1, dtype=np.int64) * cut)
                        size = size_classes(counts)
                        ask = [i for i, r in enumerate(rows) if size[i] in few[langs[r]] and counts[i].any()]
                        if ask:
                            x = vectors(counts[ask], idf)
                            yield _seen_rows([langs[r] for r in rows[ask]], h[rows[ask]], cut, size[ask],
                                             [float((own[langs[r]] @ v).max()) for r, v in zip(rows[ask], x)])
                        rows = rows[size <= last[rows]]          # a longer head has no smaller class
                        cut *= 2
                        rows = rows[length[rows] > cut]
    return run


def _low(seen: DataFrame) -> dict:
    """(lang, size): number and low quantile of the cosines, exact to 6 digits."""
    bins = seen.groupBy("lang", "size", F.round("cosine", 6).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    return {(r["lang"], r["size"]): (r["n"], r["q"]) for r in bins.groupBy("lang", "size").agg(
        F.sum("n").alias("n"), F.percentile("c", F.lit(LOW), F.col("n")).alias("q")).collect()}


def _floors(packed: DataFrame, rows: DataFrame, idf: np.ndarray, own: dict, text_col: str, lang_col: str) -> np.ndarray:
    """Floors of each centroid by size class. Where a language has few texts of a
    class, the heads of longer ones count too; where these are few, the floor of
    the class below holds, which is lower."""
    sc = packed.sparkSession.sparkContext
    seen = shared_table(packed.mapInArrow(lean(_cosines(sc.broadcast((idf, own)))), _SEEN), "cosines")
    whole = _low(seen)
    few = {lang: {k for k in range(max(s for x, s in whole if x == lang) + 1) if whole.get((lang, k), (0,))[0] < LEAST} for lang in own}
    heads = rows.mapInArrow(lean(_head_cosines(sc.broadcast((idf, own, few)), text_col, lang_col)), _SEEN)
    asked = F.lit(False)
    for lang, sizes in few.items():
        asked = asked | ((F.col("lang") == lang) & F.col("size").isin(*sorted(sizes)))
    every = _low(heads.dropDuplicates(["lang", "h", "cut"]).unionByName(seen.filter(asked)))
    floors = []
    for lang in sorted(own):
        line = np.zeros(SIZES)
        for k in range(SIZES):
            n, low = whole.get((lang, k), (0, None)) if k not in few[lang] else every.get((lang, k), (0, None))
            line[k] = MARGIN * low if n >= LEAST else line[k - 1] if k else 0.0
        floors += [line] * len(own[lang])
    return np.array(floors)


def distinct_sample(rows: DataFrame, text_col: str, lang_col: str, sample: int) -> DataFrame:
    """Of each language ``sample`` distinct texts, or all where it has fewer: those
    of the smallest hash, each once."""
    rows = rows.select(lang_col, text_col, F.xxhash64(F.lit(5), F.col(text_col)).alias("__h"))
    keys = rows.select(lang_col, "__h").distinct()
    counts = keys.groupBy(lang_col).agg(F.count(F.lit(1)).alias("__n"))     # a row per language
    # about twice as many as are needed are put in order
    place = F.pmod(F.xxhash64(F.lit(6), F.col("__h")), F.lit(1_000_000)) / F.lit(1_000_000.0)
    near = keys.join(F.broadcast(counts), lang_col).filter(place * F.col("__n") < 2 * sample + 50)
    order = F.row_number().over(Window.partitionBy(lang_col).orderBy(place, "__h"))
    drawn = near.withColumn("__r", order).filter(F.col("__r") <= sample).select(lang_col, "__h")
    return (rows.join(F.broadcast(drawn), [lang_col, "__h"]).groupBy(lang_col, "__h")
            .agg(F.min(text_col).alias(text_col)).select(text_col, lang_col))


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang", centroids: int = CENTROIDS,
        sample: int | None = None) -> Model | None:
    """Learn from the rows with a language and a text; None where there are none.

    Document frequencies cover all rows, centroids and floors all distinct texts of
    a language; only who asks for it fits these on ``sample`` texts per language.
    """
    prepare(training.sparkSession)
    rows = training.select(text_col, F.col(lang_col).cast("string").alias(lang_col)).filter(
        F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    df = dict(rows.select(text_col).mapInArrow(lean(_document_frequency(text_col)), "slot long, n long")
              .groupBy("slot").agg(F.sum("n")).collect())
    if not df.get(-1):
        return None
    idf = np.log((1.0 + df[-1]) / (1.0 + np.array([df[i] for i in range(BUCKETS)]))) + 1.0
    if sample is not None:
        rows = shared_table(distinct_sample(rows, text_col, lang_col, sample), "sample")
    rows = rows.select(lang_col, text_col, F.xxhash64(F.lit(5), F.col(text_col)).alias("__h"))
    # counts are packed once, one row a distinct text, and read by every pass
    packed = shared_table(rows.mapInArrow(lean(_packed(text_col, lang_col)), "lang string, h long, which binary, few binary, many binary")
                          .groupBy("lang", "h").agg(*(F.first(c).alias(c) for c in ("which", "few", "many"))), "packed")
    own = _centroids(packed, idf, centroids)
    if not own:
        return None
    own = {lang: c.astype(np.float32) for lang, c in sorted(own.items())}
    return Model(idf, [lang for lang, c in own.items() for _ in c], np.concatenate(list(own.values())),
                 _floors(packed, rows, idf, own, text_col, lang_col))


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _predict(model_bc, text_col: str):
    def run(batches):
        model: Model = model_bc.value
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch, lo, hi, counts in _groups(batches, text_col):
            cosine = vectors(counts, model.idf) @ model.centroids.T
            best = cosine.argmax(axis=1)
            score = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0).astype(np.float64)
            texts = batch.column(text_col)[lo:hi]
            floor = model.floors[best, size_classes(counts)]
            letter = np.array([t.is_valid and _has_letter(t.as_py()) for t in texts], dtype=bool)
            best[~letter] = len(names) - 1
            score[~letter] = 0.0
            rejected = ~letter | (score <= 0.0) | (score < floor)
            cols = batch.schema.names
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n)[lo:hi] for n in cols), pa.array(names[best], type=pa.string()), pa.array(score),
                 pa.array(rejected)], [*cols, "lang_pred", "score", "rejected"])
    return run


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected.

    lang_pred is the language of the nearest centroid; ``und``, with score 0 and
    rejected, where the text is null or has no letter, and for every row where
    nothing was learned. ``rejected`` also marks texts below the floor of that
    language for their size.
    Equal cosines go to the language that comes first by name. Columns named
    like an output column are replaced; repeated rows are judged alike.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    if model is None:
        return (docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
                .withColumn("rejected", F.lit(True)))
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return docs.mapInArrow(lean(_predict(docs.sparkSession.sparkContext.broadcast(model), text_col)), schema)


def held_out(id_col: Column) -> Column:
    """A third of the ids, by crc32; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))
