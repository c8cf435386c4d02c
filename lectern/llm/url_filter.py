"""URL filter: rules first, gradient-boosted trees on lexical features after.

The urls that a rule judges are the labelled ones. Trees are trained on a
bounded sample of them and judge the urls that no rule covers. Features: length,
path depth, digit ratio, entropy of the characters, number of parameters,
hyphens, labels of the host, and statistics of the host's suffixes and of the
first part of the path (how often it occurs, and the smoothed share of blocked
ones among its labelled urls). A labelled url sees the shares without its own
fold of urls, so that none finds its answer among its features. Suffixes are
hashed to a fixed number of buckets, so their statistics are a table of bounded
size.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import prepare

#: (host and path prefix, verdict)
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
TRAIN_ROWS = 20_000        # distinct labelled urls that the trees are fitted on, at most
SUFFIX_BUCKETS = 4096
TREES, DEPTH, SEED = 10, 4, 11
FOLDS = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("f_length", "f_path", "f_depth", "f_digits", "f_entropy", "f_params", "f_hyphens", "f_labels",
            "f_tld_seen", "f_tld_blocked", "f_site_seen", "f_site_blocked", "f_dir_seen", "f_dir_blocked")
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (ties: the first by name), or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        site, slash, rest = rule.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits per character, from the counts of its distinct characters."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.greatest(F.size(chars), F.lit(1)).cast("double")
    share = F.transform(F.array_distinct(chars),
                        lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(share, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _bucket(suffix: Column) -> Column:
    return F.pmod(F.xxhash64(suffix), F.lit(SUFFIX_BUCKETS)).cast("int")


def lexical_features(urls: DataFrame, url_col: str) -> DataFrame:
    """Add __host, __path, the suffix buckets and the lexical features."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(F.col("__host"), r"\.")
    return (urls.withColumn("__host", host_of(F.col(url_col))).withColumn("__path", path_of(F.col(url_col)))
            .withColumn("__tld", _bucket(F.substring_index("__host", ".", -1)))
            .withColumn("__site", _bucket(F.substring_index("__host", ".", -3)))
            .withColumn("__dir", _bucket(F.regexp_extract("__path", "^/[^/]*", 0)))
            .withColumn("f_length", F.length(url).cast("double"))
            .withColumn("f_path", F.length("__path").cast("double"))
            .withColumn("f_depth", F.size(F.filter(F.split("__path", "/"), lambda p: p != "")).cast("double"))
            .withColumn("f_digits", F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)))
            .withColumn("f_entropy", _entropy(url))
            .withColumn("f_params", F.size(F.filter(F.split(query, "&"), lambda p: p != "")).cast("double"))
            .withColumn("f_hyphens", F.length(F.regexp_replace(url, "[^-]", "")).cast("double"))
            .withColumn("f_labels", F.size(F.filter(labels, lambda p: p != "")).cast("double")))


def _suffix_stats(rows: DataFrame, key: str) -> DataFrame:
    """(key, seen, n, bad, folds) of at most SUFFIX_BUCKETS buckets: rows, labelled
    rows, blocked ones, and the last two by fold."""
    each = rows.groupBy(key, "__fold").agg(F.count(F.lit(1)).alias("seen"), F.count("__label").alias("n"),
                                           F.coalesce(F.sum("__label"), F.lit(0.0)).alias("bad"))
    return each.groupBy(key).agg(
        F.sum("seen").alias("__seen"), F.sum("n").alias("__n"), F.sum("bad").alias("__bad"),
        F.map_from_entries(F.collect_list(F.struct("__fold", F.struct("n", "bad")))).alias("__folds"))


def _with_suffix_stats(rows: DataFrame, stats: DataFrame, key: str, name: str) -> DataFrame:
    own = F.when(F.col("__label").isNotNull(), F.element_at("__folds", F.col("__fold")))
    bad = F.col("__bad") - F.coalesce(own["bad"], F.lit(0.0))
    n = F.col("__n") - F.coalesce(own["n"], F.lit(0))
    return (rows.join(F.broadcast(stats), key).withColumn(f"f_{name}_seen", F.log1p(F.col("__seen").cast("double")))
            .withColumn(f"f_{name}_blocked", (bad + 1.0) / (n + 2.0)).drop("__seen", "__n", "__bad", "__folds"))


def _drawn(rows: DataFrame, url_col: str, train_rows: int) -> DataFrame:
    """Of each label the rows of half of ``train_rows`` distinct urls, or of all it has,
    each url once: those of the smallest hash."""
    rows = rows.filter("__label is not null").withColumn("__h", F.xxhash64(F.lit(SEED), F.col(url_col)))
    keys = rows.select("__label", "__h").distinct()
    counts = keys.groupBy("__label").agg(F.count(F.lit(1)).alias("__k"))       # two rows
    place = F.pmod(F.xxhash64(F.lit(SEED), F.col("__h")), F.lit(1_000_000)) / F.lit(1_000_000.0)
    # about twice as many as are needed are put in order
    near = keys.join(F.broadcast(counts), "__label").filter(place * F.col("__k") < train_rows + 50)
    order = F.row_number().over(Window.partitionBy("__label").orderBy(place, "__h"))
    few = near.withColumn("__r", order).filter(F.col("__r") <= max(1, train_rows // 2)).select("__label", "__h")
    return rows.join(F.broadcast(few), ["__label", "__h"]).select("__label", "__h", *FEATURES).dropDuplicates(["__label", "__h"])


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               train_rows: int = TRAIN_ROWS, held_out: Column | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, score) per row.

    ``verdict`` is the rule's, else the trees': block where the probability
    ``score`` of a bad url is over one half. Null urls and urls without :// have
    an empty host and path and are judged by the trees. Where the labelled urls
    lack one of the verdicts, there is nothing to learn and the only verdict
    (allow if there is none) is given with a score of 0 or 1. Repeated rows are
    judged alike; other columns are ignored; an empty table gives no rows.
    Nothing is learned from the labels of rows for which ``held_out``, a
    condition on the id and the url, is true.
    """
    spark = pages.sparkSession
    prepare(spark)
    verdicts = dict(rules)
    base = lexical_features(pages.select(id_col, url_col), url_col)
    base = base.withColumn("__rule", rule_of(F.col("__host"), F.col("__path"), rules))
    ruled = F.lit(None).cast("string")
    for rule, verdict in verdicts.items():
        ruled = F.when(F.col("__rule") == rule, F.lit(verdict)).otherwise(ruled)
    base = base.withColumn("__verdict", ruled).withColumn(
        "__label", F.when(F.col("__verdict") == "block", 1.0).when(F.col("__verdict") == "allow", 0.0))
    if held_out is not None:
        base = base.withColumn("__label", F.when(~F.coalesce(held_out, F.lit(False)), F.col("__label")))
    base = base.withColumn("__fold", F.pmod(F.xxhash64(F.lit(SEED + 1), F.col(url_col)), F.lit(FOLDS)).cast("int"))
    counts = {r[0]: r[1] for r in base.filter("__label is not null").groupBy("__label").count().collect()}
    out = [F.col(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule")]
    if len(counts) < 2:
        only = 1.0 if list(counts) == [1.0] else 0.0
        return base.select(*out, F.coalesce("__verdict", F.lit("block" if only else "allow")).alias("verdict"),
                           F.lit(only).alias("score"))
    rows = base
    for name in ("tld", "site", "dir"):
        rows = _with_suffix_stats(rows, _suffix_stats(base, f"__{name}"), f"__{name}", name)
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="__x")
    trees = GBTClassifier(featuresCol="__x", labelCol="__label", predictionCol="__p",
                          maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3)
    model = trees.fit(vector.transform(_drawn(rows, url_col, train_rows)).select("__x", "__label"))
    model.setProbabilityCol("__prob").setRawPredictionCol("__raw")
    judged = model.transform(vector.transform(rows)).withColumn("score", vector_to_array("__prob")[1])
    return judged.select(*out, F.coalesce("__verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
                         .alias("verdict"), "score")
