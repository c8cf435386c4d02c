"""Parquet and export sources/sinks.

Paths go through the Hadoop FileSystem API, so the same code lists and
writes on a local disk, HDFS or an object store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators import quality as Q

SUFFIXES = (".pq", ".parquet")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def parquet_files(spark: SparkSession, source: str) -> list[str]:
    """One .pq/.parquet file, or the sorted files of a flat directory."""
    if source is None or not str(source).strip():
        raise ValueError("no path was given to read from")
    fs, p = _fs(spark, source)
    if not fs.exists(p):
        raise FileNotFoundError(f"Parquet source does not exist: {source}")
    if fs.isFile(p):
        if not str(source).lower().endswith(SUFFIXES):
            raise ValueError(f"{source} is no Parquet file")
        return [str(source)]
    files = sorted(str(s.getPath().toString()) for s in fs.listStatus(p)
                   if s.isFile() and s.getPath().getName().lower().endswith(SUFFIXES))
    if not files:
        raise FileNotFoundError(f"no Parquet shards found in {source}")
    return files


def read_shards(spark: SparkSession, source: str) -> DataFrame:
    """All shards of a source with the file each row came from."""
    return spark.read.parquet(*parquet_files(spark, source)).withColumn(
        "filename", F.col("_metadata.file_path"))


def read_articles(spark: SparkSession, source: str) -> DataFrame:
    """Scan shards, drop rows whose text is null or only spaces."""
    df = read_shards(spark, source)
    return df.where(F.col("text").isNotNull() & (F.trim(F.col("text").cast("string")) != ""))


def write_raw_shards(df: DataFrame, path: str, rows_per_file: int = 2500) -> None:
    """S3: at most ``rows_per_file`` rows per file, overwrite."""
    df.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)


def write_chunks(chunks: DataFrame, path: str, shard_col: str = "shard") -> None:
    """V1, then one output folder per input shard; rewriting a shard
    replaces only it."""
    Q.require(Q.chunk_violations(chunks), "chunks")
    (chunks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(shard_col).parquet(path))


def write_chunk_vectors(df: DataFrame, path: str, dim: int) -> None:
    """V1 + V4, then write."""
    Q.require(Q.chunk_violations(df.drop("embedding")), "chunk embeddings")
    Q.require(Q.vector_violations(df, dim, key_cols=("article_id", "idx"), check_title=False),
              "chunk embeddings")
    df.write.mode("overwrite").parquet(path)


def write_article_vectors(df: DataFrame, path: str, dim: int) -> None:
    """V2 (null / duplicate ids, length, finite), then write."""
    Q.require(Q.vector_violations(df, dim), "article embeddings")
    df.write.mode("overwrite").parquet(path)


def read_topic_assignments(spark: SparkSession, path: str) -> DataFrame | None:
    """A missing artifact means 'no topics', not an error."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    df = spark.read.parquet(path)
    missing = {"article_id", "topic_id", "topic_prob", "secondary_topics"} - set(df.columns)
    if missing:
        raise ValueError(f"the topic assignments lack {', '.join(sorted(missing))}")
    Q.require(Q.assignment_violations(df), "topic assignments")
    return df


def write_topic_assignments(df: DataFrame, path: str) -> None:
    Q.require(Q.assignment_violations(df), "topic assignments")
    df.write.mode("overwrite").parquet(path)


def write_tone_scores(df: DataFrame, path: str) -> None:
    """V9 range check, then write."""
    Q.require(Q.tone_violations(df), "tone scores")
    df.write.mode("overwrite").parquet(path)


def export_view(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a view as Parquet or CSV (arrays joined with '|', maps as JSON)."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
        return
    if fmt != "csv":
        raise ValueError("fmt must be 'parquet' or 'csv'")
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


EVAL_SCHEMA = "query string, expected_url string, notes string"


def read_eval_queries(spark: SparkSession, path: str) -> DataFrame:
    """The labelled query set (a JSON array of objects)."""
    return spark.read.schema(EVAL_SCHEMA).option("multiLine", True).json(path)
