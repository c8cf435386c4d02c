"""Nearest-chunk shortlist by cosine similarity (W1, J13) and its IVF form (M9).

Exact search over a table of queries without a cross join: the query
matrix, whose size is checked, rides along with a ``mapInArrow`` over the
corpus. Each task multiplies its batch of vectors by the query matrix,
keeps a per-query partial top-k (plus anything within rounding distance of
the k-th score, so ties resolve the same way everywhere) and emits only
those rows: tasks x queries x k, which grows with the corpus as its tasks do.
They are merged on two levels, first within some of the tasks and then per
query, so no task gets the partial lists of all tasks.

More queries than fit in one matrix are cut into groups that each make
their own pass, so nothing unbounded is ever shipped to the executors.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.config import BROADCAST_LIMIT_BYTES, RETRIEVAL_CANDIDATES
from lectern.functions.arrow import lean
from lectern.session import ensure_checkpoint_dir, written

SCORE_DIGITS = 6
_SLACK = 10.0 ** -SCORE_DIGITS
_TILE = 1 << 22            # numbers of one product: 32 MB
_MERGERS = 64              # first-level merges per query, at most


def _matrix(col: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def _partial_topk(query_ids: np.ndarray, qmat: np.ndarray, k: int, id_cols: list[str],
                  vec_col: str):
    qnorm = np.sqrt((qmat * qmat).sum(axis=1))
    qmat = qmat[qnorm > 0]
    query_ids = query_ids[qnorm > 0]
    qnorm = qnorm[qnorm > 0]

    def prune(ids, scores, qidx):
        # keep, per query, rows scoring within rounding distance of its k-th best
        keep = np.zeros(len(scores), dtype=bool)
        order = np.lexsort((-scores, qidx))
        qs, starts = np.unique(qidx[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        for s, e in zip(starts, ends):
            rows = order[s:e]
            if e - s > k:
                thr = scores[rows[k - 1]] - _SLACK
                rows = rows[scores[rows] >= thr]
            keep[rows] = True
        return [c[keep] for c in ids], scores[keep], qidx[keep]

    def tiles(batches):
        # a product of at most _TILE numbers at a time
        rows = max(1, _TILE // max(1, len(qmat)))
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                yield batch.slice(lo, rows)

    def run(batches):
        ids_acc = [[] for _ in id_cols]
        sc_acc, q_acc = [], []
        held = 0
        for batch in tiles(batches):
            n = batch.num_rows
            if n == 0 or len(qmat) == 0:
                continue
            mat = _matrix(batch.column(vec_col), n)
            cnorm = np.sqrt((mat * mat).sum(axis=1))
            with np.errstate(invalid="ignore", divide="ignore"):
                sims = (mat @ qmat.T) / (cnorm[:, None] * qnorm[None, :])
            sims[cnorm == 0, :] = -np.inf
            kk = min(k, n)
            kth = -np.partition(-sims, kk - 1, axis=0)[kk - 1] - _SLACK
            rows, qs = np.nonzero((sims >= kth[None, :]) & np.isfinite(sims))
            for j, name in enumerate(id_cols):
                ids_acc[j].append(batch.column(name).to_numpy(zero_copy_only=False)[rows])
            sc_acc.append(sims[rows, qs])
            q_acc.append(qs)
            held += len(rows)
            if held > 4 * k * len(qmat) + 65536:
                ids = [np.concatenate(a) for a in ids_acc]
                ids, sc, qi = prune(ids, np.concatenate(sc_acc), np.concatenate(q_acc))
                ids_acc = [[a] for a in ids]
                sc_acc, q_acc, held = [sc], [qi], len(sc)
        if not sc_acc:
            return
        ids = [np.concatenate(a) for a in ids_acc]
        ids, sc, qi = prune(ids, np.concatenate(sc_acc), np.concatenate(q_acc))
        cols = {"query_id": pa.array(query_ids[qi])}
        for name, arr in zip(id_cols, ids):
            cols[name] = pa.array(arr)
        cols["score"] = pa.array(sc, type=pa.float64())
        yield pa.RecordBatch.from_pydict(cols)

    return run


def collect_queries(queries: DataFrame, dim_hint: int | None = None,
                    limit_bytes: int = BROADCAST_LIMIT_BYTES) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bring the query vectors to the driver in groups of bounded size.

    The query table is the small side by contract (a request batch), but we
    still check: it is counted first and pulled in slices no larger than
    ``limit_bytes`` each.
    """
    q = queries.select("query_id", "embedding")
    count = q.count()
    if count == 0:
        return []
    dim = dim_hint or len(q.first()["embedding"])
    per_group = max(1, limit_bytes // (8 * max(dim, 1)))
    if count <= per_group:
        tbl = q.toArrow()
        return [(tbl.column("query_id").to_numpy(), _matrix(tbl.column("embedding"), tbl.num_rows))]
    groups = []
    n_groups = (count + per_group - 1) // per_group
    banded = q.withColumn("_g", F.pmod(F.xxhash64("query_id"), F.lit(n_groups)))
    for g in range(n_groups):
        tbl = banded.where(F.col("_g") == g).drop("_g").toArrow()
        if tbl.num_rows:
            groups.append((tbl.column("query_id").to_numpy(),
                           _matrix(tbl.column("embedding"), tbl.num_rows)))
    return groups


def shortlist(queries: DataFrame, corpus: DataFrame, k: int = RETRIEVAL_CANDIDATES,
              id_cols: tuple[str, ...] = ("article_id", "position"),
              vec_col: str = "embedding") -> DataFrame:
    """Top-k corpus rows per query by cosine similarity.

    queries: (query_id long, embedding); corpus: (*id_cols, embedding).
    Returns (query_id, *id_cols, score, rank); score rounded to 6 digits and
    ties broken by the id columns.
    """
    if k <= 0:
        raise ValueError(f"a shortlist of {k} rows is empty")
    spark = corpus.sparkSession
    base = corpus.select(*id_cols, vec_col)
    id_types = {f.name: f.dataType.simpleString() for f in base.schema.fields}
    schema = "query_id long, " + ", ".join(f"{c} {id_types[c]}" for c in id_cols) + ", score double"
    parts = []
    for qids, qmat in collect_queries(queries):
        fn = _partial_topk(qids.astype(np.int64), qmat, k, list(id_cols), vec_col)
        parts.append(base.mapInArrow(lean(fn), schema))
    if not parts:
        return spark.createDataFrame([], schema + ", rank int")
    cand = parts[0]
    for p in parts[1:]:
        cand = cand.unionByName(p)
    cand = cand.withColumn("score", F.round("score", SCORE_DIGITS))
    order = [F.desc("score"), *[F.asc(c) for c in id_cols]]
    first = Window.partitionBy("query_id", "_merger").orderBy(*order)
    some = (cand.withColumn("_merger", F.spark_partition_id() % _MERGERS)
            .withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k).drop("_r", "_merger"))
    w = Window.partitionBy("query_id").orderBy(*order)
    return some.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ------------------------------------------------------------------ M9: inverted-file lists


LIST_ROUNDS = 20
_TOLERANCE = 1e-4          # no centre moved further in a round: the lists are settled


def _unit_tiles(batches, vec_col: str):
    """(rows, their vectors brought to length 1); vectors without length are left out."""
    for batch in batches:
        for lo in range(0, batch.num_rows, _LIST_TILE):
            some = batch.slice(lo, _LIST_TILE)
            mat = _matrix(some.column(vec_col), some.num_rows)
            length = np.sqrt((mat * mat).sum(axis=1))
            if not length.all():
                some, mat, length = some.filter(pa.array(length > 0)), mat[length > 0], length[length > 0]
            if len(mat):
                yield some, (mat / length[:, None]).astype(np.float32)


_LIST_TILE = 2048          # vectors compared with all centres at once


def _list_sums(centres: np.ndarray, vec_col: str):
    """(list_id, n, total): of a task's vectors, the sums by nearest centre."""
    def run(batches):
        total, n = np.zeros(centres.shape), np.zeros(len(centres), dtype=np.int64)
        for _, x in _unit_tiles(batches, vec_col):
            own = (x @ centres.T).argmax(axis=1)
            order = np.argsort(own, kind="stable")
            ids, first = np.unique(own[order], return_index=True)
            total[ids] += np.add.reduceat(x[order].astype(np.float64), first, axis=0)
            n += np.bincount(own, minlength=len(n))
        ids = np.flatnonzero(n)
        if len(ids):
            yield _sum_rows(ids, n[ids], total[ids])
    return run


def _sum_rows(ids: np.ndarray, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(0, total.size + 1, total.shape[1], dtype=np.int32))
    return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(n), pa.ListArray.from_arrays(
        offsets, pa.array(total.reshape(-1)))], ["list_id", "n", "total"])


def _merge_sums(batches):
    n, total = {}, {}
    for batch in batches:
        mat = _matrix(batch.column("total"), batch.num_rows)
        for i, k, row in zip(batch.column("list_id").to_pylist(), batch.column("n").to_pylist(), mat):
            n[i], total[i] = n.get(i, 0) + k, total[i] + row if i in total else row
    if n:
        ids = sorted(n)
        yield _sum_rows(np.array(ids), np.array([n[i] for i in ids]), np.stack([total[i] for i in ids]))


def _first_centres(rows: DataFrame, n_lists: int, seed: int, vec_col: str) -> np.ndarray:
    """Different vectors with length, those of the smallest hashes."""
    keyed = rows.select(vec_col, F.xxhash64(F.lit(seed), F.col(vec_col)).alias("_h"))
    spare = n_lists + 8                                    # one hash is that of vectors without length
    keys = keyed.select("_h").distinct().orderBy("_h").limit(spare)
    own = keyed.join(F.broadcast(keys), "_h").groupBy("_h").agg(F.first(vec_col).alias("v")).orderBy("_h").collect()
    mat = np.array([r["v"] for r in own], dtype=np.float64)
    length = np.sqrt((mat * mat).sum(axis=1)) if len(mat) else np.zeros(0)
    return (mat[length > 0] / length[length > 0][:, None])[:n_lists].astype(np.float32)


SEED_STEPS = 2             # passes that draw candidates for the first centres
_SEED_ROUNDS = 30          # rounds of k-means over the candidates


def _far(centres: np.ndarray, vec_col: str, scale: float | None):
    """A task's sum of distances to the nearest centre or, with ``scale``, the unit
    vectors whose draw ``_u`` is below the scaled distance."""
    def run(batches):
        total = 0.0
        for some, x in _unit_tiles(batches, vec_col):
            far = 1.0 - np.minimum((x @ centres.T).max(axis=1).astype(np.float64), 1.0)
            total += far.sum()
            if scale is not None:
                x = x[some.column("_u").to_numpy() < far * scale]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(
                        pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.reshape(-1)))], ["v"])
        if scale is None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["far"])
    return run


def _best_seeds(x: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means over candidates, begun far apart (k-means++)."""
    rng = np.random.default_rng(seed)
    own = [int(rng.choice(len(x), p=weight / weight.sum()))]
    far = 1.0 - np.minimum(x @ x[own[0]], 1.0)
    while len(own) < min(k, len(x)):
        p = np.maximum(far, 0.0) * weight
        p[own] = 0.0
        if p.sum() <= 0:
            break
        own.append(int(rng.choice(len(x), p=p / p.sum())))
        far = np.minimum(far, 1.0 - np.minimum(x @ x[own[-1]], 1.0))
    c = x[own]
    for _ in range(_SEED_ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros(c.shape)
        np.add.at(total, near, x * weight[:, None])
        length = np.sqrt((total * total).sum(axis=1))
        c = np.where(length[:, None] > 0, total / np.maximum(length, 1e-300)[:, None], c)
    return c.astype(np.float32)


def _seeds(rows: DataFrame, n_lists: int, seed: int, vec_col: str, tasks: int) -> np.ndarray:
    """First centres from passes over all vectors (k-means||): in each, vectors far
    from the candidates are likelier drawn, some twice as many as lists; candidates
    then count the vectors that are nearest to them."""
    found = _first_centres(rows, n_lists, seed, vec_col)
    if len(found) < n_lists:
        return found                                       # no more different vectors than lists
    have = found[:1]
    for step in range(SEED_STEPS):
        far = (rows.select(vec_col).mapInArrow(lean(_far(have, vec_col, None)), "far double").agg(F.sum("far")).first()[0] or 0.0)
        if far <= 0:
            break
        u = F.xxhash64(F.lit(seed + 1 + step), F.col(vec_col)).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))
        drawn = rows.select(vec_col, u.alias("_u")).mapInArrow(
            lean(_far(have, vec_col, 2.0 * n_lists / far)), "v array<float>").distinct().collect()
        if drawn:
            have = np.concatenate([have, np.array([r["v"] for r in drawn], dtype=np.float32)])
    have = np.unique(np.concatenate([have, found]), axis=0)
    weight = np.zeros(len(have))
    for r in _sums(rows, have, vec_col, tasks):
        weight[r["list_id"]] = r["n"]
    return _best_seeds(have.astype(np.float64), np.maximum(weight, 1e-9), n_lists, seed)


def _sums(rows: DataFrame, centres: np.ndarray, vec_col: str, tasks: int) -> list:
    return (rows.select(vec_col).mapInArrow(lean(_list_sums(centres, vec_col)), _SUMS)
            .repartition(tasks, "list_id").mapInArrow(lean(_merge_sums), _SUMS).collect())


def build_lists(corpus: DataFrame, n_lists: int, seed: int = 42, vec_col: str = "embedding",
                max_iter: int = LIST_ROUNDS):
    """Cluster the corpus vectors into ``n_lists`` lists (cosine k-means over all of them).

    A round is one pass: each task multiplies its vectors with the centres and passes
    on a sum per list; a list's sums meet in one task. As many centres as lists reach
    the driver. Returns (centroids (list_id, embedding), corpus + list_id)."""
    from pyspark.sql import types as T
    spark = corpus.sparkSession
    rows = corpus.where(F.col(vec_col).isNotNull())
    tasks = max(1, min(n_lists, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    centres = _seeds(rows, n_lists, seed, vec_col, tasks)
    for _ in range(max_iter if len(centres) else 0):
        new = centres.astype(np.float64)
        for r in _sums(rows, centres, vec_col, tasks):
            total = np.array(r["total"])
            length = np.sqrt((total * total).sum())
            if length > 0:
                new[r["list_id"]] = total / length
        moved = np.sqrt(((new - centres) ** 2).sum(axis=1)).max()
        centres = new.astype(np.float32)
        if moved <= _TOLERANCE:
            break

    def assign(batches):
        for some, x in _unit_tiles(batches, vec_col):
            yield some.append_column("list_id", pa.array((x @ centres.T).argmax(axis=1).astype(np.int32)))
    schema = T.StructType([*rows.schema.fields, T.StructField("list_id", T.IntegerType())])
    centroids = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)],
                                      "list_id int, embedding array<double>")
    return centroids, rows.mapInArrow(lean(assign), schema)


_SUMS = "list_id int, n long, total array<double>"
LIST_FILE_ROWS = 1 << 17


def write_lists(corpus: DataFrame, n_lists: int, path: str | None = None, vec_col: str = "embedding", **options) -> tuple[DataFrame, str]:
    """Build the lists and write them, one folder per list: (centroids, folder)."""
    centroids, assigned = build_lists(corpus, n_lists, vec_col=vec_col, **options)
    spark = corpus.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/lists-{uuid.uuid4().hex}"
    # ranges of about as many rows each: a large list is written by several tasks, small ones share one
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-corpus.count() // LIST_FILE_ROWS))
    (assigned.withColumn("_place", F.xxhash64(F.monotonically_increasing_id()))
     .repartitionByRange(tasks, "list_id", "_place").drop("_place").write.partitionBy("list_id").parquet(path))
    return centroids, path


def ivf_shortlist(queries: DataFrame, indexed: DataFrame, centroids: DataFrame, k: int = RETRIEVAL_CANDIDATES,
                  probes: int = 32, id_cols: tuple[str, ...] = ("article_id", "position"),
                  vec_col: str = "embedding") -> DataFrame:
    """Approximate top-k: each query probes its ``probes`` nearest lists and
    ranks exactly inside them. ``probes`` equal to the list count gives the
    exact shortlist."""
    if probes <= 0:
        raise ValueError(f"{probes} lists cannot be probed")
    from lectern.operators.topics import centroid_scores
    qv = queries.select(F.col("query_id").alias("article_id"), "embedding")
    cs = centroid_scores(qv, centroids.select(F.col("list_id").alias("topic_id"), "embedding"))
    w = Window.partitionBy("article_id").orderBy(F.desc("cosine"), "topic_id")
    probe = (cs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= probes)
             .select(F.col("article_id").alias("query_id"), F.col("topic_id").alias("list_id")))
    probe = written(probe, "probes")
    spark = queries.sparkSession
    # where the lists are folders, those that no query probes are not read
    asked = [r["list_id"] for r in probe.select("list_id").distinct().collect()]     # as many as lists, at most
    indexed = indexed.where(F.col("list_id").isin(asked))
    # a block is a piece of a list with the queries that probe it; only its best rows leave it
    sizes = indexed.groupBy("list_id").agg(F.ceil(F.count(F.lit(1)) / F.lit(LIST_PIECE)).cast("int").alias("pieces"))
    sizes = written(sizes, "list_sizes")                     # a row a list
    members = indexed.select(*id_cols, vec_col, "list_id").join(sizes, "list_id").withColumn(
        "piece", F.pmod(F.xxhash64(*id_cols), F.col("pieces")).cast("int")).drop("pieces")
    asking = (probe.join(sizes, "list_id").join(queries.select("query_id", F.col("embedding").alias("_q")), "query_id")
              .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces"))
    types = {f.name: f.dataType.simpleString() for f in members.schema.fields}
    # tasks grow in number with the pieces, not in size
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(sizes.agg(F.sum("pieces")).first()[0] or 0) // TASK_PIECES))
    members, asking = (x.repartition(tasks, "list_id", "piece") for x in (members, asking))
    near = members.groupBy("list_id", "piece").cogroup(asking.groupBy("list_id", "piece")).applyInArrow(
        _best_of_block(k, list(id_cols), vec_col), "query_id long, " + ", ".join(f"{c} {types[c]}" for c in id_cols) + ", score double")
    rw = Window.partitionBy("query_id").orderBy(F.desc("score"), *[F.asc(c) for c in id_cols])
    return near.withColumn("rank", F.row_number().over(rw)).where(F.col("rank") <= k)


LIST_PIECE = 4096           # vectors of a list that a task holds at once, about
TASK_PIECES = 8             # pieces that a task reads, about
_PRODUCT = 1 << 22          # scores computed at once


def _best_of_block(k: int, id_cols: list[str], vec_col: str):
    """The ``k`` best vectors of a block for each of its queries, and all that tie with the last."""
    def run(members: pa.Table, asking: pa.Table) -> pa.Table:
        qids, rows, scores = [], [], []
        if members.num_rows and asking.num_rows:
            v, q = _matrix(members[vec_col], members.num_rows), _matrix(asking["_q"], asking.num_rows)
            ids = asking["query_id"].to_numpy()
            with np.errstate(invalid="ignore", divide="ignore"):
                v = v / np.sqrt((v * v).sum(axis=1))[:, None]
                q = q / np.sqrt((q * q).sum(axis=1))[:, None]
            step = max(1, _PRODUCT // len(v))
            for lo in range(0, len(q), step):
                s = np.round(q[lo:lo + step] @ v.T, SCORE_DIGITS)
                s = np.where(np.isnan(s), -np.inf, s)
                last = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
                own, at = np.nonzero((s >= last[:, None]) & np.isfinite(s))
                qids.append(ids[lo + own])
                rows.append(at)
                scores.append(s[own, at])
        take = pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64))
        return pa.table({"query_id": pa.array(np.concatenate(qids) if qids else [], pa.int64()),
                         **{c: members[c].take(take) for c in id_cols},
                         "score": pa.array(np.concatenate(scores) if scores else [], pa.float64())})
    return run
