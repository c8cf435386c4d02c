"""K-d tree sharding: leaves of near-equal bytes, cut at weighted medians.

Documents are points in metadata space: the id, the size, the source and the
language. The tree cuts a node across the dimension in which it is widest, at
the key that halves its bytes (or divides them as its shards are to be divided),
until every leaf holds one shard's bytes. The median comes from histograms of
fixed size over all rows, refined until the bin that holds it is small; no rows
reach the driver.

Equal texts share one point, that of their smallest id, and so one shard. A
group of equal texts larger than a fraction of a shard is dealt to several
points, so that one large group cannot unbalance the shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import prepare, shared_table

SHARDS = 16
GROUP_SHARE = 0.05         # of a shard's bytes: larger groups of equal texts are dealt to several points
TOLERANCE = 0.001          # of a shard's bytes: a cut is that exact unless one point weighs more
SLOT_ROWS = 20_000         # rows, about, that are numbered in one task
_COORD, _TIE = 20, 42      # bits of a coordinate and of the tie-breaker behind it
_BINS = 4096
_DIMS = ("d_id", "d_size", "d_source", "d_lang")


def _scaled(value: Column, low, high) -> Column:
    """A number between low and high as a coordinate."""
    if low is None or high is None or high <= low:
        return F.lit(0).cast("long")
    top = (1 << _COORD) - 1
    at = (value.cast("double") - F.lit(float(low))) / F.lit(float(high) - float(low)) * F.lit(float(top))
    return F.coalesce(F.floor(at), F.lit(0)).cast("long")


def _named(value: Column) -> Column:
    return F.pmod(F.coalesce(F.xxhash64(value), F.lit(0)), F.lit(1 << _COORD)).cast("long")


def _points(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, shards: int) -> DataFrame:
    """(id, size, crc, coordinates, tie) per row, written once."""
    body = F.coalesce(F.col(text_col), F.lit(""))
    has = set(docs.columns)
    facts = shared_table(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("crc"), F.xxhash64(body).alias("text_key"),
        *[(F.col(c) if c in has else F.lit(None)).cast("string").alias(name)
          for c, name in ((source_col, "source"), (lang_col, "lang"))]), "facts")
    whole = facts.agg(F.sum("size"), F.min(F.col("id").cast("double")), F.max(F.col("id").cast("double")), F.max("size")).first()
    total = whole[0] or 0
    limit = max(1.0, GROUP_SHARE * total / shards)
    groups = shared_table(
        facts.groupBy("text_key", "size", "crc").agg(
            F.sum("size").alias("bytes"), F.min(F.struct("id", "source", "lang")).alias("lead")), "groups")
    # two plain shuffled sides: adaptive execution splits the rows of a large group
    rows = facts.drop("source", "lang").join(groups, ["text_key", "size", "crc"])
    pieces = F.when(F.col("bytes") > limit, F.ceil(F.col("bytes") / F.lit(limit))).otherwise(1)
    piece = F.pmod(F.xxhash64("id"), pieces)
    return shared_table(rows.select(
        "id", "size", "crc", "text_key",
        _scaled(F.col("lead.id"), whole[1], whole[2]).alias("d_id"),
        _scaled(F.log(F.col("size").cast("double")), 0.0, math.log(max(whole[3] or 1, 2))).alias("d_size"),
        _named(F.col("lead.source")).alias("d_source"), _named(F.col("lead.lang")).alias("d_lang"),
        F.pmod(F.xxhash64("text_key", "crc", "size", piece), F.lit(1 << _TIE)).cast("long").alias("tie")), "points")


def _at(points: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Points with their node after the cuts of these levels. A level is one
    row per node, as many as there are shards at most. Nodes are numbered from
    1; the children of v are 2v and 2v + 1."""
    out = points.withColumn("node", F.lit(1).cast("long"))
    for cuts in levels:
        key = _key(F.col("dim"))
        out = (out.join(F.broadcast(cuts), "node", "left")
               .withColumn("node", F.when(F.col("dim").isNull(), F.col("node"))
                           .otherwise(F.col("node") * 2 + (key >= F.col("cut")).cast("long")))
               .drop("dim", "cut"))
    return out


def _key(dim: Column) -> Column:
    """The dimension's coordinate, ties broken by the point's hash."""
    coord = F.element_at(F.array(*_DIMS), dim + 1)
    return F.shiftleft(coord, _TIE) + F.col("tie")


def _medians(rows: DataFrame, todo: dict[int, tuple[int, float]], slack: float) -> dict[int, int]:
    """For each node the key that parts its bytes as wanted.

    todo: node -> (dimension, bytes wanted on the left). All nodes of a level
    share the passes; a pass brings _BINS sums per node to the driver at most.
    """
    spark = rows.sparkSession
    bins = _BINS if len(todo) <= 16 else 256
    state = {v: (0, 1 << (_COORD + _TIE), 0.0) for v in todo}     # bracket, bytes left of it
    cuts: dict[int, int] = {}
    while state:
        step = {v: max(1, -(-(hi - lo) // bins)) for v, (lo, hi, _) in state.items()}
        asked = spark.createDataFrame([(v, todo[v][0], lo, hi, step[v]) for v, (lo, hi, _) in state.items()],
                                      "node long, dim int, lo long, hi long, step long")
        sums = (rows.join(F.broadcast(asked), "node").withColumn("key", _key(F.col("dim")))
                .filter("key >= lo and key < hi")
                .groupBy("node", F.expr("(key - lo) div step").alias("bin")).agg(F.sum("size").alias("w")).collect())
        by: dict[int, list] = {v: [] for v in state}
        for r in sums:
            by[r["node"]].append((r["bin"], r["w"]))
        for v in list(state):
            lo, hi, left = state[v]
            want = todo[v][1]
            for b, w in sorted(by[v]):
                if left + w >= want:
                    if w <= slack or step[v] == 1:
                        # the nearer edge of the bin
                        cuts[v] = lo + (b + (left + w - want <= want - left)) * step[v]
                    else:
                        state[v] = (lo + b * step[v], min(hi, lo + (b + 1) * step[v]), left)
                    break
                left += w
            else:
                cuts[v] = hi
            if v in cuts:
                del state[v]
    return cuts


def shard_documents(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    lang_col: str = "lang") -> DataFrame:
    """(id, size, text_crc32, shard, slot) per row.

    Either the number of shards is given, or the bytes that a leaf may hold.
    ``size`` is the UTF-8 bytes of the text plus 1; null texts count as empty.
    ``slot`` numbers a shard's rows from 0 without gaps. Equal texts share a
    shard unless their group outweighs GROUP_SHARE of one. Null metadata and
    null ids take the coordinate 0; repeated rows take slots of their own;
    missing source or language columns leave their dimension flat; other
    columns are ignored. With fewer points than shards, some shards are empty;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    if target_bytes:
        body = F.coalesce(F.octet_length(text_col), F.lit(0)) + 1
        total = docs.agg(F.sum(body.cast("long"))).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes))
    points = _points(docs, id_col, text_col, source_col, lang_col, shards)
    leaves: dict[int, tuple[int, int]] = {1: (0, shards)}          # node -> first shard, shards
    levels: list[DataFrame] = []
    while any(n > 1 for _, n in leaves.values()):
        rows = _at(points, levels)
        stats = {r["node"]: r for r in rows.groupBy("node").agg(
            F.sum("size").alias("w"), *[f(d).alias(f"{name}_{d}") for d in _DIMS
                                        for f, name in ((F.min, "min"), (F.max, "max"))]).collect()}
        todo, total = {}, sum(r["w"] for r in stats.values())
        for v, (_, n) in leaves.items():
            if n > 1 and v in stats:
                width = [stats[v][f"max_{d}"] - stats[v][f"min_{d}"] for d in _DIMS]
                todo[v] = (width.index(max(width)), stats[v]["w"] * (n // 2) / n)
        cuts = _medians(rows, todo, TOLERANCE * total / shards) if todo else {}
        levels.append(spark.createDataFrame([(v, todo[v][0], c) for v, c in cuts.items()], "node long, dim int, cut long"))
        grown = {}
        for v, (first, n) in leaves.items():
            if v in cuts:
                grown[2 * v], grown[2 * v + 1] = (first, n // 2), (first + n // 2, n - n // 2)
            elif n == 1:
                grown[v] = (first, 1)
        leaves = grown
    names = spark.createDataFrame([(v, first) for v, (first, _) in leaves.items()], "node long, shard int")
    placed = _at(points, levels).join(F.broadcast(names), "node")
    return _numbered(placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "text_key"),
                     id_col)


def _numbered(rows: DataFrame, id_col: str) -> DataFrame:
    """Gapless slots: rows are numbered in buckets of bounded size, shifted by
    the rows of the buckets before."""
    rows = shared_table(rows, "placed")
    buckets = max(1, math.ceil(rows.count() / SLOT_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(id_col, "text_key"), F.lit(buckets)).cast("int"))
    sizes = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = shared_table(sizes.select("shard", "bucket", before.alias("shift")), "shift")
    own = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy(id_col, "text_crc32", "size")) - 1
    return (rows.withColumn("own", own).join(shift, ["shard", "bucket"])
            .select(id_col, "size", "text_crc32", "shard", (F.col("shift") + F.col("own")).cast("long").alias("slot")))
