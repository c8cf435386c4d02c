"""Text quality by a regularised quadratic discriminant.

Statistics of a whole text (shares of kinds of characters and words) are
counted, drawn towards the training rows' rates as if PRIOR more characters or
words had been seen, and brought to a steady spread by the arcsine of the root.
Each class of the labels has a mean and a covariance, which is shrunk towards
the pooled variances; its Cholesky factor is inverted once and kept in the
model. A text's score is the posterior of class 1 from the difference of the
two log densities, that is of the Mahalanobis lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import wordhash as W
from lectern.llm.common import lean, prepare, text_slices

#: Each statistic is a count, and the count that it is a share of.
SHARES = {"upper": "letters", "letters": "points", "digits": "points", "signs": "points", "calls": "points",
          "stops": "points", "again": "words", "same_as_last": "words", "open_ends": "words", "lines": "points",
          "words": "points"}
COUNTS = ("points", *SHARES)
PRIOR = 30.0                # characters or words at the training rows' rate that every text is taken to have besides
SHRINK = 0.1                # of each covariance towards the pooled variances
_FLOOR = 1e-4               # least pooled variance (shares of one in ten thousand), where a statistic never varies
_ROWS = 256                 # texts counted at once

_CALLS = [33]                                       # !
_STOPS = [34, 39, 40, 41, 44, 45, 46, 58, 59, 63]   # " ' ( ) , - . : ; ?


@dataclass
class Model:
    rates: np.ndarray        # of each statistic over the training rows
    classes: list[int]
    priors: np.ndarray       # log shares of the classes
    means: np.ndarray
    roots: np.ndarray        # inverted Cholesky factors, one a class
    logdets: np.ndarray      # log determinants of the factors


def count_texts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """COUNTS of each text, (texts, counts)."""
    n = len(off) - 1
    byte = np.stack([np.bincount(buf[a:b], minlength=256) for a, b in zip(off[:-1], off[1:])]) if n else np.zeros((0, 256), int)
    points = byte.sum(axis=1) - byte[:, 128:192].sum(axis=1)
    upper, digits = byte[:, 65:91].sum(axis=1), byte[:, 48:58].sum(axis=1)
    letters = upper + byte[:, 97:123].sum(axis=1) + byte[:, 192:].sum(axis=1)
    calls, stops = byte[:, _CALLS].sum(axis=1), byte[:, _STOPS].sum(axis=1)
    blanks = byte[:, :33].sum(axis=1) + byte[:, 127]
    signs = points - letters - digits - calls - stops - blanks
    starts, ends, first = W.find_words(buf, off, W.NOT_SPACE)
    words = np.diff(first)
    hashes, text = W.run_hashes(buf, starts, ends), np.repeat(np.arange(n), words)
    order = np.lexsort([hashes, text])
    again = np.zeros(len(order), dtype=bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    last = np.zeros(len(order), dtype=bool)
    last[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    open_ends = ~W.ALNUM[W.LOWER[buf[ends - 1]]] if len(ends) else last

    def per_text(flags, of):
        return np.bincount(of[flags], minlength=n)
    return np.stack([points, upper, letters, digits, signs, calls, stops, per_text(again, text[order]),
                     per_text(last, text), per_text(open_ends, text), byte[:, 10], words], axis=1).astype(np.int64)


def transformed(counts: np.ndarray, rates: np.ndarray) -> np.ndarray:
    at = {name: counts[:, i] for i, name in enumerate(COUNTS)}
    part = np.stack([at[s] for s in SHARES], axis=1)
    whole = np.stack([at[b] for b in SHARES.values()], axis=1)
    return np.arcsin(np.sqrt(np.clip((part + PRIOR * rates) / (whole + PRIOR), 0.0, 1.0)))


def _statistics(text_col: str):
    def run(batches):
        for batch in batches:
            rest = [n for n in batch.schema.names if n != text_col]
            for lo, hi, buf, off in text_slices(batch, text_col):
                for a in range(0, hi - lo, _ROWS):
                    b = min(a + _ROWS, hi - lo)
                    counts = count_texts(buf[off[a]:off[b]], off[a:b + 1] - off[a])
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(n)[lo + a:lo + b] for n in rest), *(pa.array(counts[:, i]) for i in range(len(COUNTS)))],
                        [*rest, *(f"q_{c}" for c in COUNTS)])
    return run


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns q_<count> in place of the text. A null text
    counts as empty; columns of these names are replaced."""
    prepare(docs.sparkSession)
    docs = docs.drop(*(f"q_{c}" for c in COUNTS))
    schema = T.StructType([f for f in docs.schema.fields if f.name != text_col]
                          + [T.StructField(f"q_{c}", T.LongType()) for c in COUNTS])
    return docs.mapInArrow(lean(_statistics(text_col)), schema)


def _matrix(batch) -> np.ndarray:
    return np.stack([batch.column(f"q_{c}").to_numpy(zero_copy_only=False) for c in COUNTS], axis=1)


def _moments(rates: np.ndarray):
    """(label, slot, value): per task the number, sums and products of the transformed statistics."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x, label = transformed(_matrix(batch), rates), batch.column("label").to_numpy(zero_copy_only=False)
            for c in np.unique(label):
                own = x[label == c]
                held = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).reshape(-1)])
                sums[int(c)] = sums.get(int(c), 0) + held
        for c, held in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(held), pa.int32()), pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held)],
                ["label", "slot", "value"])
    return run


def discriminant(moments: dict[int, np.ndarray], rates: np.ndarray, shrink: float = SHRINK) -> Model:
    """The model of per-class (number, sums, products)."""
    classes, d = sorted(moments), len(rates)
    n = np.array([moments[c][0] for c in classes])
    means = np.array([moments[c][1:d + 1] / moments[c][0] for c in classes])
    spread = [moments[c][d + 1:].reshape(d, d) / moments[c][0] - np.outer(m, m) for c, m in zip(classes, means)]
    pooled = np.maximum(sum(k / n.sum() * np.diag(s) for k, s in zip(n, spread)), _FLOOR)
    roots, logdets = [], []
    for s in spread:
        factor = np.linalg.cholesky((1 - shrink) * s + np.diag(shrink * pooled))
        roots.append(np.linalg.inv(factor))
        logdets.append(np.log(np.diag(factor)).sum())
    return Model(rates, classes, np.log(n / n.sum()), means, np.array(roots), np.array(logdets))


def posterior(model: Model, counts: np.ndarray) -> np.ndarray:
    """Probability of class 1."""
    if len(model.classes) == 1:
        return np.full(len(counts), float(model.classes[0]))
    x = transformed(counts, model.rates)
    low, high = (p - 0.5 * (((x - m) @ root.T) ** 2).sum(axis=1) - det
                 for p, m, root, det in zip(model.priors, model.means, model.roots, model.logdets))
    return 1.0 / (1.0 + np.exp(np.clip(low - high, -700.0, 700.0)))


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        shrink: float = SHRINK) -> Model | None:
    """Learn from all rows of ``statistics`` that have a label of 0 or 1.

    Sums are formed in tasks; only 2 x 133 of them reach the driver. A row with
    both labels counts once for each; null ids have no label. None where no row
    has one; with a single class the score is that class.
    """
    marks = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("__id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    rows = stats.join(marks, stats[id_col] == marks["__id"]).select("label", *(f"q_{c}" for c in COUNTS))
    total = rows.agg(*(F.sum(f"q_{c}").alias(c) for c in COUNTS)).first()
    if total["points"] is None:
        return None
    rates = np.array([total[s] / max(total[b], 1) for s, b in SHARES.items()])
    found = rows.mapInArrow(lean(_moments(rates)), "label int, slot int, value double").groupBy("label", "slot").agg(F.sum("value"))
    d = len(SHARES)
    moments: dict[int, np.ndarray] = {}
    for label, slot, value in found.collect():
        moments.setdefault(label, np.zeros(1 + d + d * d))[slot] = value
    return discriminant(moments, rates, shrink)


def _score(model_bc):
    def run(batches):
        model = model_bc.value
        for batch in batches:
            rest = [n for n in batch.schema.names if not n.startswith("q_")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(posterior(model, _matrix(batch)))],
                                             [*rest, "score"])
    return run


def score_documents(stats: DataFrame, model: Model | None) -> DataFrame:
    """Rows of ``statistics`` with ``score`` in place of the counts: the
    probability of class 1, 0.5 where nothing was learned. Empty and null texts
    are scored as such, repeated rows alike; a column named score is replaced."""
    rest = [f for f in stats.schema.fields if not f.name.startswith("q_") and f.name != "score"]
    names = [f.name for f in rest]
    if model is None:
        return stats.select(*names, F.lit(0.5).alias("score"))
    schema = T.StructType([*rest, T.StructField("score", T.DoubleType())])
    rows = stats.select(*names, *(f"q_{c}" for c in COUNTS))
    return rows.mapInArrow(_score(stats.sparkSession.sparkContext.broadcast(model)), schema)


def held_out(id_col: Column) -> Column:
    """A fifth of the ids, by crc32; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))
