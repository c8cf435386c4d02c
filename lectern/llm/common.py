"""Helpers shared by the operators of this subpackage.

* ``prepare`` makes the package importable on executors and names the shared
  checkpoint folder.
* ``shared_table`` writes an intermediate once, as Parquet, to that folder: the
  lineage is cut and any executor can be lost afterwards.
* a *sieve* is a bitmap of fixed size (the bound of what is broadcast does not
  depend on the data). A key whose bit is clear is certainly not in the set;
  a key whose bit is set still goes through an exact join, so a crowded sieve
  costs time and never changes a result.

Column names that begin with two underscores are kept for the operators; an
input column of such a name may be dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.arrow import SLICE_BYTES, lean, row_slices  # noqa: F401  (used by the operators)
from lectern.session import ensure_checkpoint_dir, ship_package

SIEVE_BITS = 26            # 2**26 bits: 8 MB
_BITMAP_BITS = 32768       # bits of one bitmap of Spark's bitmap functions


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern-{uuid.uuid4().hex}/{name}"


def shared_table(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. ``paths`` collects
    the folders of tables that the caller drops with ``forget``."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that no plan reads any more (only those just written by
    ``shared_table``, each in a folder of its own)."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    paths.clear()


# ---------------------------------------------------------------- sieves

def sieve_slot(key: Column, bits: int = SIEVE_BITS) -> Column:
    """Bit of a key that is already a uniform 64-bit hash."""
    return key.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def sieve_rows(slots: DataFrame, slot: str) -> DataFrame:
    """(part, bitmap): the set bits of ``slot``, 4 KB a row."""
    one = F.col(slot) + 1            # Spark numbers bits from 1
    return (slots.filter(F.col(slot).isNotNull())
            .groupBy(F.bitmap_bucket_number(one).alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bitmap")))


def load_sieve(rows: DataFrame, bits: int = SIEVE_BITS) -> Broadcast:
    """The bitmap as one numpy array, for Python stages. At most 2**bits bits
    reach the driver, whatever the input."""
    flat = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for part, bitmap in rows.collect():
        raw = np.frombuffer(bytes(bitmap), dtype=np.uint8)
        at = (part - 1) * (_BITMAP_BITS // 8)
        flat[at:at + len(raw)] = raw[:len(flat) - at]
    return rows.sparkSession.sparkContext.broadcast(flat)


def in_sieve(flat: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys.astype(np.uint64) & np.uint64(len(flat) * 8 - 1)
    return (flat[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def mark_in_sieve(df: DataFrame, slot: Column, rows: DataFrame, flag: str) -> DataFrame:
    """Add the boolean ``flag``: is the slot's bit set (null slot: no)."""
    one = slot + 1
    out = (df.withColumn("__part", F.bitmap_bucket_number(one))
           .withColumn("__bit", F.bitmap_bit_position(one)))
    small = rows.select(F.col("part").alias("__part"), F.col("bitmap").alias("__bitmap"))
    byte = F.conv(F.hex(F.expr("substring(__bitmap, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("shiftright(__byte, cast(__bit % 8 as int))").bitwiseAND(F.lit(1)) == 1
    return (out.join(F.broadcast(small), "__part", "left")
            .withColumn("__byte", byte)
            .withColumn(flag, F.coalesce(hit, F.lit(False)))
            .drop("__part", "__bit", "__bitmap", "__byte"))


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose id is not in ``gone`` (one id column). Only rows
    that the sieve points at are shuffled; a null id always stays."""
    spark = docs.sparkSession
    gone = shared_table(gone.select(F.col(id_col).alias("__gone")).filter("__gone is not null").distinct(), "gone")
    rows = spark.createDataFrame(
        sieve_rows(gone.select(sieve_slot(F.xxhash64("__gone")).alias("s")), "s").collect(),
        "part long, bitmap binary")
    marked = mark_in_sieve(docs, F.when(F.col(id_col).isNotNull(), sieve_slot(F.xxhash64(id_col))), rows, "__hit")
    stay = marked.filter(~F.col("__hit")).drop("__hit")
    asked = marked.filter("__hit").drop("__hit")
    return stay.unionByName(asked.join(gone, asked[id_col] == gone["__gone"], "left_anti"))


# ---------------------------------------------------------------- Arrow text

HELD = 1 << 21             # hashes that a task counts before it passes them on


def counted(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(h, n) batches: the hashes of a task with their counts, combined over
    HELD hashes at a time."""
    held, size = [], 0

    def flush():
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["h", "n"])
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= HELD:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past the last row, bytes, offsets) over a string column.

    Null texts are empty. A slice holds whole rows and at most ``limit`` bytes,
    or one longer row.
    """
    col = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    if len(col) == 0:
        return
    ends = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(col))
        yield lo, hi, raw[ends[lo]:ends[hi]], ends[lo:hi + 1] - ends[lo]
        lo = hi
    pa.default_memory_pool().release_unused()       # idle workers must not hold a batch's memory
