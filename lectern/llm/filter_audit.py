"""What each of several filters removes, alone and in every order.

A document's failures of the five filters are one of 32 masks. Counts per part
and mask (cells) are all that the audit needs. Per part a Gray code walks
through the 32 subsets of filters: one filter is toggled at a time, every cell
that fails it changes its counter of active failures, and the cells whose
counter leaves or reaches zero leave or join the running survivors. The 32
states are stored; a step of an order is the difference of two of them.

Filters (words are maximal runs of what is no ASCII white space):

* A: under 50 words
* B: fewer than 65 distinct words in 100
* C: more than 5 A-Z in 100 code points
* D: any of ``#$%&*|``
* E: the text is that of a document with a smaller id, in any part
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import lean, prepare, shared_table

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
FEW_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
SIGNS = b"#$%&*|"
_UPPER = bytes(range(65, 91))
_INNER = bytes(range(0x80, 0xC0))      # bytes of a character after its first
_PIECE = 1 << 20                       # bytes split into words at once
_PARTS = 64                            # parts whose orders are written at once

SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def count_words(text: bytes) -> tuple[int, int]:
    """(words, distinct words); memory grows with the distinct ones."""
    if len(text) <= _PIECE:
        words = text.split()
        return len(words), len(set(words))
    n, seen, rest = 0, set(), b""
    for at in range(0, len(text), _PIECE):
        piece = rest + text[at:at + _PIECE]
        words = piece.split()
        rest = b"" if not words or piece[-1:].isspace() else words.pop()
        n += len(words)
        seen.update(words)
    return (n + 1, len(seen | {rest})) if rest else (n, len(seen))


def text_failures(text: bytes) -> int:
    """Mask of the filters A to D that a text fails."""
    words, distinct = count_words(text)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _INNER))
    return ((words < FEW_WORDS) | (100 * distinct < DISTINCT_PERCENT * words) << 1
            | (100 * upper > UPPER_PERCENT * points) << 2 | (len(text.translate(None, SIGNS)) < len(text)) << 3)


def _fail(batches):
    for batch in batches:
        masks, keys = [], []
        for text in batch.column("__text").cast(pa.large_binary()):
            raw = text.as_py() or b""
            masks.append(text_failures(raw))
            keys.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("__id"), batch.column("__part"), pa.array(keys, pa.binary()), pa.array(masks, pa.int32())],
            ["__id", "__part", "__key", "__mask"])


def failure_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by failure mask.

    A null text is empty, a null part the empty string. Rows are counted one by
    one, also where ids or rows repeat. A null id is no smaller id and has
    none: such rows pass E. A document is good or toxic where any of its label
    rows says so; labels without a document count nowhere.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(part_col), F.lit("")).alias("__part"),
                       F.col(text_col).alias("__text"))
    failed = rows.mapInArrow(lean(_fail), "__id long, __part string, __key binary, __mask int")
    # repeated rows become one before anything meets on an id or a text
    failed = shared_table(failed.groupBy("__id", "__part", "__key", "__mask").agg(F.count(F.lit(1)).alias("__n")),
                          "failures")
    marks = labels.select(F.col(id_col).cast("long").alias("__id"), "quality", "toxic").filter("__id is not null").groupBy(
        "__id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("__good"),
                    F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("__toxic"))
    no = F.lit(False)
    marked = failed.filter("__id is not null").join(marks, "__id", "left").withColumns(
        {c: F.coalesce(c, no) for c in ("__good", "__toxic")})
    marked = marked.unionByName(failed.filter("__id is null").withColumns({"__good": no, "__toxic": no}))
    # copies of a text that agree in part and labels become one row, with what holds their least id
    alike = marked.groupBy("__key", "__part", "__mask", "__good", "__toxic").agg(
        F.sum("__n").alias("__all"), F.sum(F.when(F.col("__id").isNull(), F.col("__n"))).alias("__nameless"),
        F.min(F.when(F.col("__id").isNotNull(), F.struct("__id", "__n"))).alias("__least"))
    least = F.min("__least.__id").over(Window.partitionBy("__key"))
    first = F.when(F.col("__least.__id") == least, F.col("__least.__n"))
    passed = F.coalesce(first, F.lit(0)) + F.coalesce("__nameless", F.lit(0))
    split = alike.withColumn("__passed", passed).select("__part", "__good", "__toxic", F.explode(F.array(
        F.struct(F.col("__mask").alias("mask"), F.col("__passed").alias("n")),
        F.struct(F.col("__mask").bitwiseOR(F.lit(COPY)).alias("mask"), (F.col("__all") - F.col("__passed")).alias("n")),
    )).alias("c"))
    return split.select(F.col("__part").alias("part"), "c.mask", "c.n", "__good", "__toxic").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("__good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("__toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def walk_subsets(cells: np.ndarray, n_filters: int) -> np.ndarray:
    """Survivors of every subset of filters. ``cells`` is (parts, masks, counts);
    the result has the same shape, with subsets in place of masks."""
    states = np.empty_like(cells)
    masks = np.arange(1 << n_filters)
    failures = np.zeros(1 << n_filters, dtype=np.int64)      # active filters that each cell fails
    alive, subset = cells.sum(axis=1), 0
    states[:, 0] = alive
    for turn in range(1, 1 << n_filters):
        toggled = turn & -turn
        subset ^= toggled
        own = masks[(masks & toggled) > 0]
        if subset & toggled:
            alive = alive - cells[:, own[failures[own] == 0]].sum(axis=1)
            failures[own] += 1
        else:
            failures[own] -= 1
            alive = alive + cells[:, own[failures[own] == 0]].sum(axis=1)
        states[:, subset] = alive
    return states


def order_steps(states: np.ndarray, n_filters: int) -> dict[str, np.ndarray]:
    """For (parts, orders, steps): what the stored states say of each step."""
    orders = np.array(list(permutations(range(n_filters))))
    before = np.concatenate([np.zeros((len(orders), 1), dtype=np.int64), np.cumsum(1 << orders, axis=1)], axis=1)
    lost = states[:, before[:, :-1]] - states[:, before[:, 1:]]
    removed = lost[..., 0]
    every = (1 << n_filters) - 1
    fails = np.stack([states[:, 0, 0] - states[:, 1 << f, 0] for f in range(n_filters)], axis=1)
    alone = np.stack([states[:, every ^ 1 << f, 0] - states[:, every, 0] for f in range(n_filters)], axis=1)
    share = np.stack([(removed * (orders == f)).sum(axis=(1, 2)) for f in range(n_filters)], axis=1)
    return {"kept": states[:, before[:, 1:], 0], "removed": removed, "redundant": fails[:, orders] - removed,
            "unique_fails": alone[:, orders], "good_lost": lost[..., 1], "toxic_lost": lost[..., 2],
            "shapley": share[:, orders]}


def _walk(batches):
    n = len(FILTERS)
    names = ["".join(o) for o in permutations(FILTERS)]
    for batch in batches:
        for lo in range(0, batch.num_rows, _PARTS):
            some = batch.slice(lo, _PARTS)
            cells = np.zeros((some.num_rows, 1 << n, 3), dtype=np.int64)
            for i, own in enumerate(some.column("cells").to_pylist()):
                for c in own:
                    cells[i, c["mask"]] = c["n"], c["good"], c["toxic"]
            steps = order_steps(walk_subsets(cells, n), n)
            each = len(names) * n
            yield pa.RecordBatch.from_arrays(
                [some.column("part").take(pa.array(np.repeat(np.arange(some.num_rows), each))),
                 pa.array(np.tile(np.repeat(np.array(names, dtype=object), n), some.num_rows), pa.string()),
                 pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), some.num_rows * len(names))),
                 *(pa.array(v.reshape(-1)) for v in steps.values())],
                ["part", "filter_order", "step", *steps])


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source") -> DataFrame:
    """One row per part, order of the filters and step, with the counts within the part.

    kept and removed are those of the step, redundant fail its filter but went
    earlier, unique_fails fail no other filter, good_lost and toxic_lost are
    labelled documents among the removed, shapley sums the filter's removed over
    all orders. Only counts by part and mask, at most 32 a part, leave the
    documents. No documents, no rows; null handling as in ``failure_cells``.
    """
    cells = failure_cells(docs, labels, id_col, text_col, part_col)
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return parts.mapInArrow(_walk, SCHEMA)
