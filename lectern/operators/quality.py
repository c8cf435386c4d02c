"""Data-quality rules (V1-V14) as DataFrames of violations.

Every dataset gets ``violations(df) -> (rule, key, detail)``: row rules
are evaluated in one pass (an array of failed rule names per row, exploded),
key rules (duplicates) are one ``groupBy`` each. ``require_*`` raises
``ValueError`` with the first violation, for jobs that must stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATION_SCHEMA = "rule string, key string, detail string"


def _blank(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"^\s+|\s+\z", "") == ""


def _row_rules(df: DataFrame, key: Column, rules: list[tuple[str, Column]]) -> DataFrame:
    failed = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda x: x.isNotNull())
    return (df.select(key.cast("string").alias("key"), failed.alias("_f"))
            .select(F.explode("_f").alias("rule"), "key").select("rule", "key", F.lit(None).cast("string").alias("detail")))


def _dupes(df: DataFrame, cols: list[str], rule: str) -> DataFrame:
    g = df.groupBy(*cols).count().where(F.col("count") > 1)
    key = F.concat_ws(",", *[F.col(c).cast("string") for c in cols])
    return g.select(F.lit(rule).alias("rule"), key.alias("key"),
                    F.concat(F.lit("count="), F.col("count").cast("string")).alias("detail"))


def _missing(df: DataFrame, required) -> list[str]:
    return sorted(set(required) - set(df.columns))


def _non_finite(arr: Column) -> Column:
    return F.exists(arr, lambda x: F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))


def _is_integral(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))


def chunk_violations(df: DataFrame) -> DataFrame:
    """V1: columns present, no nulls, no blank text, unique (article_id, idx)."""
    miss = _missing(df, ("article_id", "title", "idx", "chunk_text"))
    if miss:
        raise ValueError(f"the chunks lack {', '.join(miss)}")
    key = F.concat_ws(",", F.col("article_id").cast("string"), F.col("idx").cast("string"))
    rows = _row_rules(df, key, [
        ("chunk_null", F.col("article_id").isNull() | F.col("idx").isNull() | F.col("chunk_text").isNull()
         | F.col("title").isNull()),
        ("chunk_blank", F.col("chunk_text").isNotNull() & _blank(F.col("chunk_text"))),
    ])
    return rows.unionByName(_dupes(df, ["article_id", "idx"], "chunk_duplicate"))


def vector_violations(df: DataFrame, dim: int, key_cols=("article_id",), check_title: bool = True) -> DataFrame:
    """V2/V4: integer id, not null, unique key, title present, length, finite."""
    if not _is_integral(df, key_cols[0]):
        raise ValueError(f"{key_cols[0]} holds no whole numbers")
    key = F.concat_ws(",", *[F.col(c).cast("string") for c in key_cols])
    rules = [
        ("id_null", F.col(key_cols[0]).isNull()),
        ("vector_null", F.col("embedding").isNull()),
        ("vector_length", F.col("embedding").isNotNull() & (F.size("embedding") != dim)),
        ("vector_non_finite", F.col("embedding").isNotNull() & _non_finite(F.col("embedding"))),
    ]
    if check_title and "title" in df.columns:
        rules.append(("title_null", F.col("title").isNull()))
    return _row_rules(df, key, rules).unionByName(_dupes(df, list(key_cols), "id_duplicate"))


def document_violations(df: DataFrame, key: str = "article_id", text: str = "text") -> DataFrame:
    """V3/V7: integer id, no nulls, unique, not blank."""
    if not _is_integral(df, key):
        raise ValueError(f"{key} holds no whole numbers")
    rows = _row_rules(df, F.col(key), [
        ("id_null", F.col(key).isNull()),
        ("text_null", F.col(text).isNull()),
        ("text_blank", F.col(text).isNotNull() & _blank(F.col(text))),
    ])
    return rows.unionByName(_dupes(df, [key], "id_duplicate"))


def raw_article_violations(df: DataFrame) -> DataFrame:
    """V6: id, url, text present and not blank; id unique in the batch."""
    miss = _missing(df, ("article_id", "url", "title", "author", "published_at", "text", "tags"))
    if miss:
        raise ValueError(f"the articles lack {', '.join(miss)}")
    rows = _row_rules(df, F.col("article_id"), [
        ("id_null", F.col("article_id").isNull()),
        ("url_null", F.col("url").isNull()),
        ("text_null", F.col("text").isNull()),
        ("url_blank", F.col("url").isNotNull() & _blank(F.col("url"))),
        ("text_blank", F.col("text").isNotNull() & _blank(F.col("text"))),
    ])
    return rows.unionByName(_dupes(df, ["article_id"], "id_duplicate"))


def tone_violations(df: DataFrame, labels=("academic", "militant", "hopeful", "critical")) -> DataFrame:
    """V9: every score finite and within 0..1."""
    rules = [(f"{lb}_range", F.col(lb).isNull() | F.isnan(lb) | (F.col(lb) < 0) | (F.col(lb) > 1))
             for lb in labels]
    return _row_rules(df, F.col("article_id"), rules).unionByName(_dupes(df, ["article_id"], "id_duplicate"))


def assignment_violations(df: DataFrame) -> DataFrame:
    """Ids present and unique, probabilities finite and within 0..1."""
    p = F.col("topic_prob")
    sec_bad = F.exists(F.coalesce(F.col("secondary_topics"), F.array().cast(
        "array<struct<topic_id:int,probability:double>>")),
        lambda s: s["probability"].isNull() | F.isnan(s["probability"]) | (s["probability"] < 0)
        | (s["probability"] > 1))
    rows = _row_rules(df, F.col("article_id"), [
        ("id_null", F.col("article_id").isNull()),
        ("prob_range", p.isNull() | F.isnan(p) | (p < 0) | (p > 1)),
        ("secondary_range", sec_bad),
    ])
    return rows.unionByName(_dupes(df, ["article_id"], "id_duplicate"))


def title_violations(chunks: DataFrame) -> DataFrame:
    """One title per article."""
    g = chunks.groupBy("article_id").agg(F.countDistinct("title").alias("n"))
    return g.where(F.col("n") > 1).select(F.lit("title_conflict").alias("rule"),
                                          F.col("article_id").cast("string").alias("key"),
                                          F.concat(F.lit("titles="), F.col("n").cast("string")).alias("detail"))


def source_url_violations(raw: DataFrame) -> DataFrame:
    """A source id must map to one url."""
    g = raw.groupBy("article_id").agg(F.countDistinct(F.trim("url")).alias("n"))
    return g.where(F.col("n") > 1).select(F.lit("url_conflict").alias("rule"),
                                          F.col("article_id").cast("string").alias("key"),
                                          F.concat(F.lit("urls="), F.col("n").cast("string")).alias("detail"))


def cross_shard_violations(df: DataFrame, shard_col: str = "shard", key: str = "article_id") -> DataFrame:
    """An id that occurs in more than one shard."""
    g = df.groupBy(key).agg(F.countDistinct(shard_col).alias("n"))
    return g.where(F.col("n") > 1).select(F.lit("id_in_many_shards").alias("rule"),
                                          F.col(key).cast("string").alias("key"),
                                          F.concat(F.lit("shards="), F.col("n").cast("string")).alias("detail"))


def star_violations(store: dict[str, DataFrame]) -> DataFrame:
    """Uniques and foreign keys of the serving star."""
    a, t, at, tp, ch = (store[k] for k in ("articles", "tags", "article_tags", "topics", "chunks"))
    parts = [
        _dupes(a, ["id"], "article_id_duplicate"), _dupes(a, ["url"], "article_url_duplicate"),
        _dupes(t, ["name"], "tag_name_duplicate"), _dupes(ch, ["article_id", "position"], "chunk_duplicate"),
        _dupes(at, ["article_id", "tag_id"], "article_tag_duplicate"),
    ]

    def orphan(df, col, ref, ref_col, rule):
        o = df.where(F.col(col).isNotNull()).select(F.col(col).alias("_k")).distinct() \
            .join(ref.select(F.col(ref_col).alias("_k")), "_k", "left_anti")
        return o.select(F.lit(rule).alias("rule"), F.col("_k").cast("string").alias("key"),
                        F.lit(None).cast("string").alias("detail"))

    parts += [
        orphan(ch, "article_id", a, "id", "chunk_without_article"),
        orphan(at, "article_id", a, "id", "link_without_article"),
        orphan(at, "tag_id", t, "id", "link_without_tag"),
        orphan(a, "topic_id", tp, "id", "article_topic_missing"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require(violations: DataFrame, what: str) -> None:
    first = violations.limit(1).collect()
    if first:
        r = first[0]
        raise ValueError(f"{what}: {r.rule} at {r.key}" + (f" ({r.detail})" if r.detail else ""))


def require_raw_articles(df: DataFrame) -> None:
    require(raw_article_violations(df), "raw articles")
