"""Density clusters of vectors (M6): core points, their components, border points.

Two vectors are neighbours within ``eps``. A core point has ``min_points``
neighbours, itself included; core points that are neighbours share a cluster, any
other point joins the nearest core point in reach, or is noise (-1).

The neighbours come from an exact join over a grid: the coordinates of largest
variance cut space into cells of side ``eps``, so neighbours lie in one cell or
in adjacent ones. Cells are cut into pieces of bounded size, and two pieces of
adjacent cells make one block, which a task compares as matrices. A block sends
out counts, a spanning forest of its links, or the nearest core points: never
its pairs. So a crowded cell costs blocks, not a task of its own.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.config import OUTLIER_TOPIC_ID
from lectern.operators.components import components
from lectern.session import discard, written

GRID_DIMS = 3
PIECE = 1024                # points of a side of a block, about


def _grid(points: DataFrame, eps: float, dims: int, piece: int, scratch: list[str]) -> DataFrame:
    """points with their cell (array of ints) and the piece of it that they are in."""
    d = len(points.first()["v"])
    spread = points.select(*[F.var_pop(F.col("v")[k]).alias(str(k)) for k in range(d)]).first()
    axes = sorted(range(d), key=lambda k: (-(spread[k] or 0.0), k))[:dims]
    celled = points.withColumn("cell", F.array(*[F.floor(F.col("v")[k] / F.lit(eps)).cast("long") for k in axes]))
    sizes = celled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(piece)).cast("int").alias("pieces"))
    return written(celled.join(sizes, "cell").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")),
                   "density_points", scratch)


def _blocks(placed: DataFrame, dims: int, scratch: list[str]) -> DataFrame:
    """(block, cell, piece, side): the pieces that each block compares."""
    pieces = placed.select("cell", "piece").distinct()
    # of two adjacent cells the one with the step that comes first in order asks
    steps = [s for s in product((-1, 0, 1), repeat=dims) if s >= (0,) * dims]
    asked = pieces.select("cell", "piece", F.explode(F.array(*[F.array(*[F.lit(x).cast("long") for x in s]) for s in steps])).alias("step"))
    asked = asked.withColumn("near", F.zip_with("cell", "step", lambda x, y: x + y))
    pairs = asked.join(pieces.select(F.col("cell").alias("near"), F.col("piece").alias("other")), "near")
    pairs = pairs.where((F.col("near") != F.col("cell")) | (F.col("piece") <= F.col("other")))
    pairs = pairs.withColumn("block", F.struct("cell", "piece", "near", "other"))
    own = pairs.select("block", "cell", "piece", F.lit(0).alias("side"))
    far = pairs.where((F.col("near") != F.col("cell")) | (F.col("piece") != F.col("other"))).select(
        "block", F.col("near").alias("cell"), F.col("other").alias("piece"), F.lit(1).alias("side"))
    return written(own.unionByName(far), "density_blocks", scratch)


def _near(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Squared distances, infinite beyond ``eps``; summed coordinate by coordinate."""
    d = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        d += (a[:, k, None] - b[None, :, k]) ** 2
    return np.where(d <= eps * eps, d, np.inf)


def _sides(rows: pa.Table):
    """The points of both sides of a block: (index, vectors); one piece alone is compared with itself."""
    side = rows["side"].to_numpy()
    v = rows["v"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return v, left, right if len(right) else left


def _neighbour_counts(eps: float):
    def run(rows: pa.Table) -> pa.Table:
        v, left, right = _sides(rows)
        hit = np.isfinite(_near(v[left], v[right], eps))
        n = np.zeros(rows.num_rows, dtype=np.int64)
        n[left] += hit.sum(axis=1)
        if right is not left:
            n[right] += hit.sum(axis=0)
        return pa.table({"id": rows["id"], "n": pa.array(n)})
    return run


def _forest(a: np.ndarray, b: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Of the links a-b as few as connect the same nodes."""
    root = list(range(size))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            kept.append((x, y))
    return kept


def _core_links(eps: float):
    """Links between core points (distance null), and for other points the nearest core point of the block."""
    def run(rows: pa.Table) -> pa.Table:
        v, left, right = _sides(rows)
        ids, core = rows["id"].to_numpy(), rows["core"].to_numpy(zero_copy_only=False)
        near = _near(v[left], v[right], eps)
        i, j = np.nonzero(np.isfinite(near) & core[left][:, None] & core[right][None, :])
        links = _forest(left[i], right[j], rows.num_rows)
        a, b = [ids[x] for x, _ in links], [ids[y] for _, y in links]
        dist: list = [None] * len(links)
        for own, other, d in ((left, right, near), (right, left, near.T)):
            cores = np.flatnonzero(core[other])
            cores = cores[np.argsort(ids[other][cores])]              # equal distances: the smallest id
            edge = np.flatnonzero(~core[own])
            if len(cores) and len(edge):
                best = d[np.ix_(edge, cores)]
                at = best.argmin(axis=1)
                for x, c, far in zip(edge, at, best[np.arange(len(edge)), at]):
                    if np.isfinite(far):
                        a.append(ids[own[x]])
                        b.append(ids[other[cores[c]]])
                        dist.append(float(far))
            if right is left:
                break
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "d": pa.array(dist, pa.float64())})
    return run


def density_clusters(vectors: DataFrame, eps: float, min_points: int, min_cluster_size: int = 1, id_col: str = "article_id",
                     vec_col: str = "embedding", dims: int = GRID_DIMS, piece: int = PIECE) -> DataFrame:
    """(id, topic_id, core): clusters numbered by size, ties by smallest member, -1 for noise.

    Clusters below ``min_cluster_size`` are noise as well. Rows without an id or
    a vector are ignored; ids must be unique. A border point in reach of several
    clusters joins that of its nearest core point (ties: the smallest id)."""
    spark = vectors.sparkSession
    scratch: list[str] = []
    points = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    if points.isEmpty():
        return points.select(F.col("id").alias(id_col), F.lit(OUTLIER_TOPIC_ID).alias("topic_id"), F.lit(False).alias("core"))
    dims = min(dims, len(points.first()["v"]))
    placed = _grid(points, eps, dims, piece, scratch)
    blocks = _blocks(placed, dims, scratch)
    members = placed.join(blocks, ["cell", "piece"]).select("block", "side", "id", "v")
    counts = members.groupBy("block").applyInArrow(_neighbour_counts(eps), "id long, n long")
    core = written(counts.groupBy("id").agg((F.sum("n") >= min_points).alias("core")), "density_core", scratch)
    flagged = placed.join(core, "id").join(blocks, ["cell", "piece"]).select("block", "side", "id", "v", "core")
    found = written(flagged.groupBy("block").applyInArrow(_core_links(eps), "a long, b long, d double"), "density_links", scratch)
    own = core.where("core").select(F.col("id").alias("a"), F.col("id").alias("b"))     # core points without links too
    labels = written(components(found.where("d is null").select("a", "b").unionByName(own)), "density_labels", scratch)
    border = (found.where("d is not null").groupBy("a").agg(F.min(F.struct("d", "b")).alias("best"))
              .select(F.col("a").alias("id"), F.col("best.b").alias("node")).join(labels, "node").select("id", "label"))
    member = written(labels.withColumnRenamed("node", "id").unionByName(border), "density_members", scratch)
    sizes = member.groupBy("label").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= min_cluster_size)
    ranked = sizes.withColumn("topic_id", (F.row_number().over(Window.orderBy(F.desc("size"), "label")) - 1).cast("int"))   # a row a cluster
    out = written(core.join(member, "id", "left").join(ranked.select("label", "topic_id"), "label", "left").select(
        F.col("id").alias(id_col), F.coalesce("topic_id", F.lit(OUTLIER_TOPIC_ID)).alias("topic_id"), "core"), "density")
    discard(spark, scratch)
    return out
