"""Exact n-gram Jaccard join with signature trees.

Two texts link when their sets of word shingles have a Jaccard similarity of
at least ``similar`` (in hundredths). The join never compares all pairs:

1. Texts with equal shingle sets form one class; only classes are joined.
2. Blocks. Shingles are put in one global order, rare before frequent: the
   three tenths with the smallest hashes are counted exactly over all classes,
   a count sketch over all texts ranks the frequent ones. Two similar sets
   share a shingle among the first n - ceil(s n) + 1 of each, so classes meet
   in the blocks of their first shingles; a class whose first shingles are its
   own alone has no similar one and leaves. Blocks with the same members are one.
3. Pivots. In a few rounds each block links its members to one pivot; members
   that already are in one component need no comparison among themselves, which
   settles large groups of copies with a linear number of pairs. A pair whose
   smallest hashes hardly agree is not compared here; if it links after all, the
   trees find it.
4. Signature trees. In the blocks left, nodes hold the OR and the AND of their
   members' token bitmaps and the range of set sizes. A dual traversal drops a
   pair of nodes when the largest overlap that these allow is too small. Large
   blocks are cut into cells, so no task gets a whole hot block.
5. Surviving pairs are verified on the full sets.

Classes and shingles are 64-bit hashes; nothing is capped or sampled.
"""

from __future__ import annotations

import math
import uuid
import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm import wordhash as W
from lectern.llm.common import (counted, forget, in_sieve, lean, load_sieve, prepare, shared_path, shared_table, sieve_rows,
                                sieve_slot, text_slices)
from lectern.llm.components import components

WORDS = 5
SIMILAR = 80               # hundredths
PIVOT_ROUNDS = 3
CELL = 1024                # members of a block that one side of a cell holds
_SKETCH_BITS = 20          # counters of the frequency sketch: fixed, 8 MB
_BLOCKS = 64               # the sketch travels in so many parts
_SLICE = 1 << 20             # bytes of text at once
_SMALLEST = 32              # hashes of a set by which a pivot's pairs are chosen
_LOW = np.uint64(int(0.3 * 2**64))     # hashes below are counted exactly


def _sets(batches, text_col: str, words: int, copies=None):
    """Per slice: batch, first row, and for each of its texts the sorted
    distinct shingle hashes. With ``copies``, a sieve of the hashed ids of texts
    that repeat the set of another one, those texts are left out."""
    for batch in batches:
        skip = np.zeros(batch.num_rows, dtype=bool)
        if copies is not None:
            skip = in_sieve(copies.value, batch.column("__key").to_numpy(zero_copy_only=False))
        for lo, hi, buf, off in text_slices(batch, text_col, _SLICE):
            buf = W.LOWER[buf]
            starts, ends, first = W.find_words(buf, off, W.NOT_SPACE)
            hashes = W.run_hashes(buf, starts, ends)
            at, shingles = W.windows(hashes, first, words)
            bounds = np.searchsorted(at, first)
            counts = np.diff(first)
            short = np.flatnonzero((counts > 0) & (counts < words))
            whole = dict(zip(short.tolist(), W.run_hashes(hashes, first[short], first[short + 1])))
            yield batch, lo, [np.array([whole[d]]) if d in whole else np.unique(shingles[bounds[d]:bounds[d + 1]])
                              for d in np.flatnonzero(~skip[lo:hi]).tolist()]


def _class_of(s: np.ndarray) -> int:
    return int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


_PROFILE = "__id {id_type}, n long, c long, part int, counts binary"


def _profile(id_col: str, text_col: str, words: int):
    """A row per text (set size, class), then the task's part of the sketch."""
    def run(batches):
        sketch = np.zeros(1 << _SKETCH_BITS, dtype=np.int64)
        kind = None
        for batch, lo, sets in _sets(batches, text_col, words):
            kind = batch.column(id_col).type
            for s in sets:
                sketch[(s >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)] += 1
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col)[lo:lo + n], pa.array([len(s) for s in sets], type=pa.int64()),
                 pa.array([_class_of(s) if len(s) else None for s in sets], type=pa.int64()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], ["__id", "n", "c", "part", "counts"])
        if kind is not None:
            parts = [zlib.compress(p.astype(np.uint32).tobytes(), 1) for p in np.split(sketch, _BLOCKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(_BLOCKS, kind), pa.nulls(_BLOCKS, pa.int64()), pa.nulls(_BLOCKS, pa.int64()),
                 pa.array(range(_BLOCKS), type=pa.int32()), pa.array(parts, type=pa.binary())],
                ["__id", "n", "c", "part", "counts"])
    return run


def _add_sketches(batches):
    """Sum the parts that arrive in a task, one row at a time."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = np.frombuffer(zlib.decompress(raw.as_py()), dtype=np.uint32)
            total[part] = total.get(part, 0) + counts.astype(np.int64)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), type=pa.int32()), pa.array([t.tobytes() for t in total.values()])],
            ["part", "counts"])


def _levels(profile: DataFrame) -> np.ndarray:
    """0 for a counter that chance explains, else the logarithm of its count."""
    rows = (profile.filter("part is not null").select("part", "counts")
            .repartition(_BLOCKS, "part").mapInArrow(lean(_add_sketches), "part int, counts binary").collect())
    counts = np.zeros((_BLOCKS, (1 << _SKETCH_BITS) // _BLOCKS), dtype=np.int64)
    for part, raw in rows:
        counts[part] += np.frombuffer(raw, dtype=np.int64)
    counts = counts.reshape(-1)
    mean = counts.mean()
    hot = counts > mean + 8 * np.sqrt(mean) + 16
    return np.where(hot, 1 + np.log2(np.maximum(counts, 1)), 0).astype(np.uint8)


def _low_shingles(text_col: str, words: int, copies):
    """The shingles with small hashes, of each class once a task."""
    def parts(batches):
        seen = set()
        for _, _, sets in _sets(batches, text_col, words, copies):
            new = []
            for s in sets:
                if len(s) and (c := _class_of(s)) not in seen:
                    seen.add(c)
                    new.append(s[:np.searchsorted(s, _LOW)])
            if new:
                yield np.concatenate(new)

    def run(batches):
        yield from counted(parts(batches))
    return run


def _first_shingles(text_col: str, words: int, similar: int, copies, shared, levels):
    """(class, size, first shingles in the global order, thousandths of its low
    hashes that no other class has), each class once a task.

    The order: low hashes that no other class has, then the hashes that were
    not counted, then low hashes that several classes have, rare before
    frequent. Shingles of the first kind meet no one and are left out; a class
    that has nothing else among its first shingles has no similar one.
    """
    def run(batches):
        flat, level, seen = shared.value, levels.value, set()
        for _, _, sets in _sets(batches, text_col, words, copies):
            rows = []
            for s in sets:
                n = len(s)
                if not n or (c := _class_of(s)) in seen:
                    continue
                seen.add(c)
                first = n - -(-similar * n // 100) + 1
                low = int(np.searchsorted(s, _LOW))
                many = in_sieve(flat, s[:low])
                alone = low - int(many.sum())
                if alone >= first:
                    continue
                turn = np.ones(n, dtype=np.uint8)
                turn[:low] = np.where(many, 2 + level[(s[:low] >> np.uint64(64 - _SKETCH_BITS)).astype(np.int64)], 0)
                rows.append((c, n, s[np.argsort(turn, kind="stable")[alone:first]].view(np.int64),
                             1000 * alone // max(low, 1)))
            if rows:
                firsts = [r[2] for r in rows]
                bounds = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], type=pa.int64()), pa.array([r[1] for r in rows], type=pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(firsts))),
                     pa.array([r[3] for r in rows], type=pa.int64())],
                    ["c", "n", "hs", "alone"])
    return run


def _shared_postings(shared):
    """(shingle, class, size, alone) of the shingles that the sieve holds."""
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            h = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            take = np.flatnonzero(in_sieve(shared.value, h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[take]), batch.column(0).take(pa.array(row[take])),
                 batch.column(1).take(pa.array(row[take])), batch.column(3).take(pa.array(row[take]))],
                ["h", "c", "n", "alone"])
    return run


def _full_sets(text_col: str, words: int, copies, wanted):
    """(class, whole set, ascending) of the classes that the sieve holds, once a task."""
    def run(batches):
        seen = set()
        for _, _, sets in _sets(batches, text_col, words, copies):
            classes = np.array([_class_of(s) if len(s) else 0 for s in sets], dtype=np.int64)
            hit = in_sieve(wanted.value, classes)
            rows = []
            for i in np.flatnonzero(hit).tolist():
                if len(sets[i]) and classes[i] not in seen:
                    seen.add(classes[i])
                    rows.append((int(classes[i]), sets[i]))
            if rows:
                bounds = np.concatenate([[0], np.cumsum([len(s) for _, s in rows])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in rows], type=pa.int64()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate([s for _, s in rows]).view(np.int64)))],
                    ["c", "s"])
    return run


# ---------------------------------------------------------------- signature trees

def bitmap_bits(n: int) -> int:
    """Bits of the token bitmap of a set of n shingles, a power of two."""
    return max(64, 1 << (4 * n - 1).bit_length())


def _bitmaps(batches):
    """(class, token bitmap) from (class, set)."""
    for batch in batches:
        out = []
        for s in batch.column(1):
            h = s.values.to_numpy().view(np.uint64)
            flags = np.zeros(bitmap_bits(len(h)), dtype=np.uint8)
            flags[(h & np.uint64(len(flags) - 1)).astype(np.int64)] = 1
            out.append(np.packbits(flags, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.binary())], ["c", "bitmap"])


class _Node:
    """Some members of a block: OR and AND of their bitmaps, range of sizes, the
    component and the earlier blocks that all of them are in."""

    __slots__ = ("some", "every", "bits", "least", "most", "comp", "member", "earlier", "left", "right")


def _folded(bitmap: int, bits: int, to: int) -> int:
    while bits > to:
        bits >>= 1
        bitmap = (bitmap >> bits) | (bitmap & ((1 << bits) - 1))
    return bitmap


def _tree(members: list[tuple]) -> _Node:
    """members: (component, size, class, bitmap, bits, earlier blocks), sorted."""
    node = _Node()
    if len(members) == 1:
        node.comp, node.least, node.member, bitmap, node.bits, node.earlier = members[0]
        node.most, node.some, node.every = node.least, bitmap, bitmap
        node.left = node.right = None
        return node
    half = len(members) // 2
    a, b = _tree(members[:half]), _tree(members[half:])
    node.left, node.right, node.member = a, b, None
    node.bits = min(a.bits, b.bits)
    node.some = _folded(a.some, a.bits, node.bits) | _folded(b.some, b.bits, node.bits)
    node.every = _folded(a.every, a.bits, node.bits) & _folded(b.every, b.bits, node.bits)
    node.least, node.most = min(a.least, b.least), max(a.most, b.most)
    node.comp = a.comp if a.comp == b.comp else None
    node.earlier = a.earlier & b.earlier
    return node


def _may_link(x: _Node, y: _Node, similar: int) -> bool:
    """Can any member of x reach the similarity with any of y, and is this the
    first block that they share? (A pair comes out of its first block alone.)"""
    if x.comp is not None and x.comp == y.comp:
        return False
    if 100 * min(x.most, y.most) < similar * max(x.least, y.least):
        return False
    if not x.earlier.isdisjoint(y.earlier):
        return False
    bits = min(x.bits, y.bits)
    # a bit that every set of x has and no set of y: a token of x that y lacks
    lost_x = (_folded(x.every, x.bits, bits) & ~_folded(y.some, y.bits, bits)).bit_count()
    lost_y = (_folded(y.every, y.bits, bits) & ~_folded(x.some, x.bits, bits)).bit_count()
    overlap = min(x.most - lost_x, y.most - lost_y)
    return 100 * overlap >= similar * (x.least + y.least - overlap)


def _dual(x: _Node, y: _Node, similar: int, out: list) -> None:
    stack = [(x, y)]
    while stack:
        x, y = stack.pop()
        if x is y:
            if x.left is not None and x.comp is None:
                stack += [(x.left, x.left), (x.right, x.right), (x.left, x.right)]
        elif _may_link(x, y, similar):
            if x.left is None and y.left is None:
                out.append((min(x.member, y.member), max(x.member, y.member)))
            elif y.left is None or (x.left is not None and x.most - x.least >= y.most - y.least):
                stack += [(x.left, y), (x.right, y)]
            else:
                stack += [(x, y.left), (x, y.right)]


def _cell_pairs(block: int, members: list[tuple], similar: int) -> list[tuple[int, int]]:
    """members: (side, component, size, class, bitmap bytes, blocks); side 0 and
    1 of a cell off the diagonal, side 0 alone on it."""
    out: list[tuple[int, int]] = []
    sides: list[list[tuple]] = [[], []]
    for side, comp, n, c, raw, blocks in members:
        # neighbours have sizes within a quarter, then a first block, then one component
        band = n.bit_length() * 4 + (n << 2 >> (n.bit_length() - 1)) % 4
        earlier = frozenset(b for b in blocks if b < block)
        sides[side].append(((band, min(blocks), comp, n, c),
                            (comp, n, c, int.from_bytes(raw, "little"), 8 * len(raw), earlier)))
    trees = [_tree([m for _, m in sorted(s, key=lambda m: m[0])]) for s in sides if s]
    _dual(trees[0], trees[-1], similar, out)
    return out


def _tree_pairs(similar: int):
    """Rows arrive sorted by cell (h, i, j)."""
    def run(batches):
        cell, members = None, []
        for batch in (b.slice(lo, 512) for b in batches for lo in range(0, b.num_rows, 512)):
            out = []
            for h, i, j, *member in zip(*(col.to_pylist() for col in batch.columns)):
                if (h, i, j) != cell:
                    if len(members) > 1:
                        out += _cell_pairs(cell[0], members, similar)
                    cell, members = (h, i, j), []
                members.append(member)
            if out:
                yield _pairs(out)
        if len(members) > 1 and (out := _cell_pairs(cell[0], members, similar)):
            yield _pairs(out)
    return run


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    made = np.array(rows, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], ["a", "b"])


# ---------------------------------------------------------------- the join

def _by_class(sets: DataFrame, paths: list[str]) -> tuple[DataFrame, str]:
    """``sets`` written in buckets of the class, so that no join on it shuffles
    them again, and the name of the table."""
    spark = sets.sparkSession
    path, name = shared_path(spark, "sets"), f"lectern_sets_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets.repartition(n, "c").write.bucketBy(n, "c").option("path", path).saveAsTable(name)
    paths.append(path)
    return spark.table(name), name


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs that share at least half of their smallest hashes; of sets that are
    similar enough, nearly all."""
    few = F.slice("s", 1, _SMALLEST)
    a = sets.select(F.col("c").alias("a"), few.alias("ka"))
    b = sets.select(F.col("c").alias("b"), few.alias("kb"))
    shared = F.size(F.array_intersect("ka", "kb"))
    return pairs.join(b, "b").join(a, "a").filter(2 * shared >= F.least(F.size("ka"), F.size("kb"))).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs whose sets are similar enough. The side with the pivots comes
    last, where its rows are wide and a frequent pivot is split."""
    a = sets.select(F.col("c").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("c").alias("b"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(b, "b").join(a, "a")
            .filter(100 * both >= similar * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def _band(n: Column, similar: int) -> Column:
    """Sets whose sizes allow the similarity are at most one band apart; bands are
    a little wider than that needs, so that rounding cannot part them."""
    return F.floor(F.log(n.cast("double")) / F.lit(1.0001 * math.log(100 / min(similar, 99)))).cast("int")


def _open_blocks(rows: DataFrame) -> DataFrame:
    """(h, band, size, pivot) of the blocks with more than one component left;
    ``size`` counts the block, the pivot is that of the band of set sizes."""
    bands = shared_table(rows.groupBy("h", "band").agg(
        F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
        F.min(F.struct("turn", "c", "n", "comp")).alias("pivot")), "bands")
    blocks = (bands.groupBy("h").agg(F.sum("n").alias("size"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
              .filter("lo < hi").select("h", "size"))
    return bands.join(blocks, "h").select("h", "band", "size", "pivot")


def _labelled(postings: DataFrame, links: DataFrame | None, turn: int, similar: int) -> DataFrame:
    rows = postings.select("h", "c", "n", "alone")
    if links is None:
        rows = rows.withColumn("comp", F.col("c"))
    else:
        found = components(links)
        rows = (rows.join(found.select(F.col("node").alias("c"), "label"), "c", "left")
                .select("h", "c", "n", "alone", F.coalesce("label", "c").alias("comp")))
    # the first pivot is the member with the fewest shingles of its own: of many
    # edited copies of one text the least edited; later ones are any member
    own = F.col("alone") if turn == 0 else F.lit(0).cast("long")
    return (rows.withColumn("turn", F.struct(own.alias("own"), F.xxhash64(F.lit(turn), "c").alias("any")))
            .withColumn("band", _band(F.col("n"), similar)))


def _copies(rows: DataFrame):
    """A sieve of hashed ids whose texts need not be read again, their class
    being that of a smaller id. No first id of a class is in it: ids that share
    a bit with one are left out, and so are null ids."""
    key = F.xxhash64("__id")
    known = rows.filter("c is not null and __id is not null").select("c", "__id", sieve_slot(key).alias("s"))
    first = known.groupBy("c").agg(F.min("__id").alias("first"))
    marked = known.join(first, "c").withColumn("copy", F.col("__id") > F.col("first"))
    slots = marked.groupBy("s").agg(F.bool_and("copy").alias("only"))
    return load_sieve(sieve_rows(slots.filter("only").select("s"), "s"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = WORDS, similar: int = SIMILAR) -> DataFrame:
    """(id, n_shingles, component_id) per document row.

    component_id is the smallest id reachable by links, the row's own included.
    Words are runs of non-blanks, A-Z lower-cased; a text with fewer words than
    a shingle has its whole sequence as one shingle; a text without words, or
    null, has no shingles and links with nothing (component_id is its own id).
    Texts with equal sets link. Rows that share an id are separate rows of one
    id; a null id counts for nothing in component_id, which is null where no id
    is known. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    scratch: list[str] = []
    source = docs.select(id_col, text_col)
    id_type = dict(docs.dtypes)[id_col]
    profile = shared_table(source.mapInArrow(lean(_profile(id_col, text_col, words)), _PROFILE.format(id_type=id_type)), "profile")
    rows = profile.filter("n is not null").select("__id", "n", "c")
    levels = spark.sparkContext.broadcast(_levels(profile))
    copies = _copies(rows)
    texts = docs.select(text_col, F.xxhash64(id_col).alias("__key"))

    several = load_sieve(sieve_rows(
        texts.mapInArrow(lean(_low_shingles(text_col, words, copies)), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
        .filter("n > 1").select(sieve_slot(F.col("h")).alias("s")), "s"))
    firsts = shared_table(texts.mapInArrow(lean(_first_shingles(text_col, words, similar, copies, several, levels)),
                                           "c long, n long, hs array<long>, alone long"), "firsts", scratch)
    more = (firsts.select(F.explode("hs").alias("h")).groupBy("h").count().filter("count > 1")
            .select(sieve_slot(F.col("h")).alias("s")))
    shared = load_sieve(sieve_rows(more, "s"))
    postings = shared_table(firsts.mapInArrow(lean(_shared_postings(shared)), "h long, c long, n long, alone long")
                            .dropDuplicates(["h", "c"]), "postings", scratch)
    # blocks of the same members are one block: count, range and sums of two hashes tell them apart
    blocks = (postings.groupBy("h").agg(
        F.count(F.lit(1)).alias("size"), F.min("c").alias("lo"), F.max("c").alias("hi"),
        F.bit_xor(F.xxhash64("c")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "c")).alias("y"))
        .filter("size > 1").groupBy("size", "lo", "hi", "x", "y").agg(F.min("h").alias("h")))
    # similar sets lie in one band or in neighbouring ones: members without such company leave
    postings = postings.withColumn("band", _band(F.col("n"), similar))
    company = (postings.groupBy("h", "band").agg(F.count(F.lit(1)).alias("k"))
               .select("h", "k", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
               .groupBy("h", "band").agg(F.sum("k").alias("k")).filter("k > 1"))
    kept = shared_table(company.join(blocks, "h", "left_semi").select("h", "band"), "blocks", scratch)
    postings = shared_table(postings.join(kept, ["h", "band"], "left_semi").drop("band"), "kept", scratch)

    wanted = load_sieve(sieve_rows(postings.select(sieve_slot(F.col("c")).alias("s")).distinct(), "s"))
    sets, sets_name = _by_class(texts.mapInArrow(lean(_full_sets(text_col, words, copies, wanted)), "c long, s array<long>")
                                .dropDuplicates(["c"]), scratch)
    for held in (levels, copies, several, shared, wanted):
        held.destroy()

    links: DataFrame | None = None
    for turn in range(PIVOT_ROUNDS):
        open_rows = shared_table(_labelled(postings, links, turn, similar), "labelled", scratch)
        pivots = shared_table(_open_blocks(open_rows), "pivots", scratch)
        open_rows = shared_table(open_rows.join(pivots, ["h", "band"]).select(
            "h", "c", "n", "alone", "comp", F.col("pivot.c").alias("pc"), F.col("pivot.n").alias("pn"),
            F.col("pivot.comp").alias("pcomp")), "open", scratch)
        pairs = (open_rows.filter(F.col("comp") != F.col("pcomp"))
                 .filter(100 * F.least("n", "pn") >= similar * F.greatest("n", "pn"))
                 .select(F.col("pc").alias("a"), F.col("c").alias("b")).distinct())
        near = shared_table(_near(pairs, sets), "near", scratch)
        found = shared_table(_verified(near, sets, similar), "links", scratch)
        links = found if links is None else links.unionByName(found)
        postings = open_rows.select("h", "c", "n", "alone")

    # what is left: signature trees, in cells of bounded size
    open_rows = shared_table(_labelled(postings, links, PIVOT_ROUNDS, similar), "labelled", scratch)
    left = _open_blocks(open_rows).select("h", "size").distinct()
    open_rows = shared_table(open_rows.join(left, "h").select("h", "size", "c", "n", "comp"), "left", scratch)
    sides = F.ceil(F.col("size") / F.lit(CELL)).cast("int")
    rest = (open_rows.withColumn("sides", sides)
            .withColumn("own", F.pmod(F.xxhash64("c", F.lit(7)), F.col("sides")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
            .select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                    F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "comp", "n", "c"))
    own = (open_rows.groupBy("c").agg(F.collect_set("h").alias("blocks"))
           .join(sets.mapInArrow(lean(_bitmaps), "c long, bitmap binary"), "c"))
    cells = rest.join(shared_table(own, "members", scratch), "c").select("h", "i", "j", "side", "comp", "n", "c", "bitmap", "blocks")
    pairs = shared_table(cells.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
                         .mapInArrow(lean(_tree_pairs(similar)), "a long, b long"), "pairs", scratch)
    found = shared_table(_verified(pairs, sets, similar), "tree_links", scratch)
    labels = components(found if links is None else links.unionByName(found))
    spark.sql(f"DROP TABLE {sets_name}")
    forget(spark, scratch)

    member = (rows.join(labels.select(F.col("node").alias("c"), "label"), "c", "left")
              .select("__id", "n", F.coalesce("label", "c").alias("comp")))
    smallest = shared_table(member.filter("comp is not null").groupBy("comp")
                            .agg(F.min("__id").alias("smallest")), "smallest")
    return member.join(smallest, "comp", "left").select(
        F.col("__id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("smallest", "__id").alias("component_id"))
