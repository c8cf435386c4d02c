"""The serving store on disk: keyed tables in buckets, merged load by load (W6,
W7, S9, E3), with views kept by deltas and catalog statistics (S12).

Every table is dealt to a fixed number of buckets by a hash of its key. A load
finds the buckets that its keys fall into, reads these, and writes them anew
under the load's version; all others stay as they are. The pointer file names
the version of each bucket and is replaced in one step at the end, so a reader
sees all of a load or nothing, and a load that died leaves only files that
nothing names. States of earlier loads are kept until ``expire``.

Two views are tables of the store as well: articles per tag, and per topic the
articles and the sums of their tone. A load subtracts what the changed articles
had contributed and adds what they contribute now; sums are decimals, so the
views equal a recomputation exactly.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.config import TONE_LABELS
from lectern.operators import store as S
from lectern.session import discard, written

POINTER = "CURRENT"
BUCKETS = 64                # of each table, fixed when a store is made

#: Each table with the key that deals its rows.
KEYS = {"articles": "url", "tags": "name", "article_tags": "article_id", "topics": "id", "chunks": "article_id",
        "tone": "article_id", "tag_counts": "tag_id", "topic_stats": "topic_id"}
_SUM = "decimal(38,6)"
VIEW_SCHEMAS = {"tag_counts": "tag_id long, n_articles long",
                "topic_stats": "topic_id int, n_articles long, n_toned long, "
                               + ", ".join(f"sum_{lb} {_SUM}" for lb in TONE_LABELS)}


def bucket_of(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], VIEW_SCHEMAS[name]) if name in VIEW_SCHEMAS else S.empty_store(spark)[name]


# ------------------------------------------------------------------ state


def read_state(spark: SparkSession, root: str, buckets: int = BUCKETS) -> dict:
    """What the pointer says, or the state of a store that has no load yet.

    The pointer is the first file of a store, so tables without one mean damage:
    that is an error, not an empty store."""
    root = root.rstrip("/")
    if not S.path_exists(spark, f"{root}/{POINTER}"):
        if any(S.path_exists(spark, f"{root}/{name}") for name in KEYS):
            raise RuntimeError(f"{root} has tables but no {POINTER} pointer")
        return {"version": None, "buckets": buckets, "max_id": {}, "tables": {name: {} for name in KEYS}}
    return json.loads(S.get_text(spark, f"{root}/{POINTER}"))


def read_table(spark: SparkSession, root: str, state: dict, name: str, buckets=None) -> DataFrame:
    """A table of a state, or some of its buckets."""
    own = state["tables"][name]
    paths = [f"{root.rstrip('/')}/{name}/{own[b]}/bucket={b}" for b in sorted(own, key=int) if buckets is None or int(b) in buckets]
    empty = _empty(spark, name)
    return spark.read.schema(empty.schema).parquet(*paths) if paths else empty


def read_store(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the state that the pointer names; empty ones where nothing was loaded."""
    state = read_state(spark, root)
    return {name: read_table(spark, root, state, name) for name in KEYS}


def touched_buckets(keys: DataFrame, key: str, n: int) -> set[int]:
    """Buckets that the keys fall into, at most ``n`` numbers."""
    rows = keys.where(F.col(key).isNotNull()).select(bucket_of(F.col(key), n).alias("b")).distinct().collect()
    return {r.b for r in rows}


class _Load:
    """One load: the old state, what it reads and what it writes."""

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        self.spark, self.root = spark, root.rstrip("/")
        self.old = read_state(spark, root, buckets)
        self.n = self.old["buckets"]
        self.new = json.loads(json.dumps(self.old))
        self.new["version"] = dt.datetime.now(dt.timezone.utc).strftime("v%Y%m%dT%H%M%S%f")
        self.scratch: list[str] = []
        if self.old["version"] is None:
            S.put_text(spark, f"{self.root}/{POINTER}", json.dumps(self.old))

    def read(self, name: str, buckets: set[int]) -> DataFrame:
        return read_table(self.spark, self.root, self.old, name, buckets)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, name, self.scratch)

    def put(self, name: str, df: DataFrame, buckets: set[int]) -> DataFrame:
        """Replace the buckets by ``df``; the rows as they are read from now on."""
        if not buckets:
            return _empty(self.spark, name)
        path = f"{self.root}/{name}/{self.new['version']}"
        (df.withColumn("bucket", bucket_of(F.col(KEYS[name]), self.n)).repartition("bucket")
         .write.partitionBy("bucket").parquet(path))
        own, made = self.new["tables"][name], set(S.list_names(self.spark, path))
        for b in buckets:
            own.pop(str(b), None)
            if f"bucket={b}" in made:                                 # a bucket can run empty
                own[str(b)] = self.new["version"]
        return read_table(self.spark, self.root, self.new, name, buckets)

    def next_id(self, name: str) -> int:
        return self.old["max_id"].get(name, 0) + 1

    def note_ids(self, name: str, rows: DataFrame) -> None:
        top = rows.agg(F.max("id")).first()[0] or 0
        self.new["max_id"][name] = max(self.old["max_id"].get(name, 0), top)

    def commit(self) -> None:
        text = json.dumps(self.new)
        S.put_text(self.spark, f"{self.root}/states/{self.new['version']}.json", text)
        S.put_text(self.spark, f"{self.root}/{POINTER}", text)
        discard(self.spark, self.scratch)


# ------------------------------------------------------------------ views


def _contributions(ids: DataFrame, articles: DataFrame, tone: DataFrame, sign: int) -> DataFrame:
    """(topic_id, n_articles, n_toned, sums) of the articles with these ids, times ``sign``."""
    a = articles.join(ids, "id", "left_semi").where(F.col("topic_id").isNotNull()).select(
        F.col("id").alias("article_id"), "topic_id")
    j = a.join(tone, "article_id", "left")
    one = F.lit(sign).cast("long")
    toned = F.col(TONE_LABELS[0]).isNotNull()
    return j.select("topic_id", one.alias("n_articles"), F.when(toned, one).otherwise(0).alias("n_toned"),
                    *[(F.coalesce(F.round(lb, 6), F.lit(0)).cast(_SUM) * sign).cast(_SUM).alias(f"sum_{lb}") for lb in TONE_LABELS])


def _add_up(view: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """The view with the delta added; keys without articles leave."""
    sums = [(F.sum(f.name).cast(f.dataType)).alias(f.name) for f in view.schema.fields if f.name != key]
    return view.unionByName(delta.select(*view.columns)).groupBy(key).agg(*sums).where("n_articles > 0").select(*view.columns)


def _refresh_views(load: _Load, ids: DataFrame, articles: tuple, links: tuple, tone: tuple) -> None:
    """``articles``, ``links`` and ``tone`` are (before, after) of the touched buckets."""
    delta = load.keep(_contributions(ids, articles[0], tone[0], -1).unionByName(
        _contributions(ids, articles[1], tone[1], 1)), "topic_delta")
    touched = touched_buckets(delta, "topic_id", load.n)
    load.put("topic_stats", _add_up(load.read("topic_stats", touched), delta, "topic_id"), touched)
    own = ids.withColumnRenamed("id", "article_id")
    delta = load.keep(links[0].join(own, "article_id", "left_semi").select("tag_id", F.lit(-1).cast("long").alias("n_articles"))
                      .unionByName(links[1].join(own, "article_id", "left_semi").select("tag_id", F.lit(1).cast("long").alias("n_articles")))
                      .groupBy("tag_id").agg(F.sum("n_articles").alias("n_articles")).where("n_articles <> 0"), "tag_delta")
    touched = touched_buckets(delta, "tag_id", load.n)
    load.put("tag_counts", _add_up(load.read("tag_counts", touched), delta, "tag_id"), touched)


def topic_tone_means(store: dict[str, DataFrame]) -> DataFrame:
    """A9 from the view: per topic its articles and the mean of each tone."""
    return store["topic_stats"].select("topic_id", "n_articles", *[
        F.round(F.col(f"sum_{lb}").cast("double") / F.col("n_toned"), 6).alias(f"mean_{lb}") for lb in TONE_LABELS])


def tag_frequency(store: dict[str, DataFrame]) -> DataFrame:
    """A8 from the view: articles per tag name."""
    return store["tag_counts"].join(store["tags"].select(F.col("id").alias("tag_id"), "name"), "tag_id").select("name", "n_articles")


# ------------------------------------------------------------------ load


def merge_load(spark: SparkSession, root: str, raw: DataFrame, chunk_vectors: DataFrame | None = None,
               assignments: DataFrame | None = None, tone: DataFrame | None = None, load_ts: dt.datetime | None = None,
               expected_dimension: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Load raw articles with what belongs to them into the store at ``root``; the summary row.

    The rules are those of ``store.load``. Only buckets that a key of the load
    falls into are read and written; new ids follow the largest ones, which the
    state keeps. ``buckets`` counts only when the store is made. Nothing is visible
    before the pointer is replaced; loading the same rows again changes no row."""
    from lectern.operators.quality import require_raw_articles
    require_raw_articles(raw)
    load = _Load(spark, root, buckets)
    batch = load.keep(S.prepare_batch(raw), "load_batch")
    urls = touched_buckets(batch, "url", load.n)
    before = load.read("articles", urls)
    articles, source_map = S.upsert_articles(before, batch, load_ts, load.next_id("articles"))
    source_map = load.keep(source_map, "load_ids")
    matched = None
    if chunk_vectors is not None:
        unknown = S.unknown_source_ids(chunk_vectors, source_map).limit(1).collect()
        if unknown:
            raise ValueError(f"chunks of article {unknown[0].source_id!r}, which is not in the batch")
    if assignments is not None:
        topics = touched_buckets(S.topic_ids(assignments), "id", load.n)
        load.put("topics", S.placeholder_topics(load.read("topics", topics), assignments), topics)
        articles, matched = S.apply_topics(articles, assignments, source_map)
    articles = load.put("articles", articles, urls)
    load.note_ids("articles", articles)

    names = load.keep(batch.select(F.explode("tags").alias("name")).distinct(), "load_tags")
    touched = touched_buckets(names, "name", load.n)
    tags = load.put("tags", S.upsert_tags(load.read("tags", touched), names, load.next_id("tags")), touched)
    load.note_ids("tags", tags)

    ids = load.keep(source_map.select("id").distinct(), "load_changed")
    own = touched_buckets(ids, "id", load.n)
    links = load.read("article_tags", own)
    links = links, load.put("article_tags", S.upsert_article_tags(links, batch, source_map, tags), own)
    if chunk_vectors is not None:
        load.put("chunks", S.upsert_chunks(load.read("chunks", own), chunk_vectors, source_map, expected_dimension), own)
    tones = load.read("tone", own)
    tones = tones, tones if tone is None else load.put("tone", S.upsert_tone(tones, tone, source_map), own)
    _refresh_views(load, ids, (before, articles), links, tones)
    summary = spark.createDataFrame(S.load_summary(batch, chunk_vectors, matched).collect(),
                                    "articles long, tags long, chunks long, topic_articles long")
    load.commit()
    return summary


def write_store(store: dict[str, DataFrame], root: str, buckets: int = BUCKETS) -> str:
    """Write whole tables as a new version of a store; its version. The views are made anew."""
    spark = next(iter(store.values())).sparkSession
    load = _Load(spark, root, buckets)
    every = set(range(load.n))
    made = {name: load.put(name, store[name], every) for name in KEYS if name in store and name not in VIEW_SCHEMAS}
    for name in ("articles", "tags"):
        load.note_ids(name, made[name])
    for name in VIEW_SCHEMAS:
        load.new["tables"][name] = {}
        load.old["tables"][name] = {}
    nothing = _empty(spark, "articles"), _empty(spark, "article_tags"), _empty(spark, "tone")
    _refresh_views(load, made["articles"].select("id"), (nothing[0], made["articles"]), (nothing[1], made["article_tags"]),
                   (nothing[2], made["tone"]))
    load.commit()
    return load.new["version"]


# ------------------------------------------------------------------ versions and catalog


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Forget all but the last ``keep`` states and delete the buckets that none of
    the others names, leftovers of dead loads included; how many were deleted."""
    root = root.rstrip("/")
    current = read_state(spark, root)
    states = S.list_names(spark, f"{root}/states")
    kept = sorted(states)[-max(keep, 1):]
    named = {(name, version, b) for state in [current, *(json.loads(S.get_text(spark, f"{root}/states/{s}")) for s in kept)]
             for name, own in state["tables"].items() for b, version in own.items()}
    gone = 0
    for name in KEYS:
        for version in S.list_names(spark, f"{root}/{name}"):
            folders = [f for f in S.list_names(spark, f"{root}/{name}/{version}") if f.startswith("bucket=")]
            old = [f for f in folders if (name, version, f.removeprefix("bucket=")) not in named]
            discard(spark, [f"{root}/{name}/{version}/{f}" for f in old] if len(old) < len(folders) else [f"{root}/{name}/{version}"])
            gone += len(old)
    discard(spark, [f"{root}/states/{s}" for s in states if s not in kept])
    return gone


def register_tables(spark: SparkSession, root: str, database: str) -> None:
    """The store's tables in the catalog, with fresh statistics.

    A table is partitioned by bucket; each partition points to the folder that
    the state names, so only buckets that changed are moved and analyzed. The
    table's own row count comes from the files' footers."""
    root, state = root.rstrip("/"), read_state(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in KEYS:
        table, schema = f"{database}.{name}", _empty(spark, name).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, bucket int) USING parquet PARTITIONED BY (bucket) "
                  f"LOCATION '{root}/{name}'")
        known = {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        own = state["tables"][name]
        for b in sorted(known - set(own)):
            spark.sql(f"ALTER TABLE {table} DROP PARTITION (bucket={b})")
        for b, version in sorted(own.items()):
            path, at = f"{root}/{name}/{version}/bucket={b}", f"{table} PARTITION (bucket={b})"
            if b not in known:
                spark.sql(f"ALTER TABLE {table} ADD PARTITION (bucket={b}) LOCATION '{path}'")
            elif any(r.col_name == "Location" and r.data_type.endswith(f"/{version}/bucket={b}")
                     for r in spark.sql(f"DESCRIBE EXTENDED {at}").collect()):
                continue
            else:
                spark.sql(f"ALTER TABLE {at} SET LOCATION '{path}'")
            spark.sql(f"ANALYZE TABLE {at} COMPUTE STATISTICS")
        spark.sql(f"REFRESH TABLE {table}")
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def row_counts(spark: SparkSession, database: str) -> dict[str, int]:
    """Row counts of the registered tables, from the catalog's statistics alone."""
    out = {}
    for name in KEYS:
        for r in spark.sql(f"DESCRIBE EXTENDED {database}.{name}").collect():
            if r.col_name == "Statistics" and "rows" in r.data_type:
                out[name] = int(r.data_type.split(",")[1].split()[0])
    return out
