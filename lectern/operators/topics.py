"""Topic operators: assignments (W2, M7), class-based term weights (A13),
labels (A14), alignment and hierarchy (M10, M11), and a distributed topic
fit (M5, M6, M8).

Term weights follow the published class-based TF-IDF: the documents of a
class are counted together, counts are L1-normalised per class and scaled
by ``ln(1 + A / f_t)`` where A is the mean word count per class (truncated
to an integer) and f_t the term's total count. Only n-grams that may be
frequent are formed and counted (``termfreq``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.config import (OUTLIER_TOPIC_ID, TOPIC_MIN_CLUSTER_SIZE, TOPIC_MIN_DF, TOPIC_NGRAM_RANGE,
                            TOPIC_PCA_COMPONENTS, TOPIC_TOP_TERMS)
from lectern.functions.tokens import tokens
from lectern.operators.termfreq import counted_terms
from lectern.session import written

# Default English stop words of the term vectorizer (a short
# list of function words; pass a longer one through ``stop_words``).
STOP_WORDS = (
    "a", "about", "above", "after", "again", "against", "all", "also", "am", "an", "and", "any",
    "are", "as", "at", "be", "because", "been", "before", "being", "below", "between", "both",
    "but", "by", "can", "could", "did", "do", "does", "doing", "down", "during", "each", "few",
    "for", "from", "further", "had", "has", "have", "having", "he", "her", "here", "hers",
    "herself", "him", "himself", "his", "how", "i", "if", "in", "into", "is", "it", "its",
    "itself", "just", "me", "more", "most", "my", "myself", "no", "nor", "not", "now", "of",
    "off", "on", "once", "only", "or", "other", "our", "ours", "ourselves", "out", "over", "own",
    "same", "she", "should", "so", "some", "such", "than", "that", "the", "their", "theirs",
    "them", "themselves", "then", "there", "these", "they", "this", "those", "through", "to",
    "too", "under", "until", "up", "very", "was", "we", "were", "what", "when", "where", "which",
    "while", "who", "whom", "why", "will", "with", "would", "you", "your", "yours", "yourself",
    "yourselves",
)

PROB_DIGITS = 6


# ------------------------------------------------------------------ W2


def secondary_topics(primary: DataFrame, probs: DataFrame, top: int = 3) -> DataFrame:
    """(article_id, topic_id) + long probabilities (article_id, topic_id, probability)
    -> (article_id, topic_id, topic_prob, secondary_topics).

    topic_prob is the primary topic's probability, 0.0 when it has no column
    (the outlier -1); secondary is the ``top`` best other topics by
    (-probability, topic_id)."""
    p = probs.select("article_id", F.col("topic_id").cast("int").alias("tid"),
                     F.round(F.col("probability").cast("double"), PROB_DIGITS).alias("prob"))
    j = primary.select("article_id", F.col("topic_id").cast("int").alias("topic_id")).join(p, "article_id", "left")
    g = j.groupBy("article_id", "topic_id").agg(
        F.max(F.when(F.col("tid") == F.col("topic_id"), F.col("prob"))).alias("_pp"),
        F.array_sort(F.collect_list(F.when((F.col("tid") != F.col("topic_id")) & F.col("tid").isNotNull(),
                                           F.struct((-F.col("prob")).alias("n"), F.col("tid").alias("t"))))
                     ).alias("_o"))
    sec = F.transform(F.slice("_o", 1, top), lambda s: F.struct(
        s["t"].alias("topic_id"), (-s["n"]).alias("probability")))
    return g.select("article_id", "topic_id", F.coalesce("_pp", F.lit(0.0)).alias("topic_prob"),
                    sec.alias("secondary_topics"))


# ------------------------------------------------------------------ M7


def _centroid_scores_fn(ids: np.ndarray, cmat: np.ndarray, id_col: str, vec_col: str):
    cn = np.sqrt((cmat * cmat).sum(axis=1))

    def run(batches):
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            col = b.column(vec_col)
            mat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            vn = np.sqrt((mat * mat).sum(axis=1))
            with np.errstate(invalid="ignore", divide="ignore"):
                sims = (mat @ cmat.T) / (vn[:, None] * cn[None, :])
            rid = b.column(id_col).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict({
                id_col: pa.array(np.repeat(rid, len(ids))),
                "topic_id": pa.array(np.tile(ids, n).astype(np.int32)),
                "cosine": pa.array(sims.reshape(-1), type=pa.float64()),
            })
    return run


def _centroid_groups(cents: DataFrame, vec_col: str, limit_bytes: int | None):
    """(topic ids ascending, matrix) of the centroids in groups whose size is
    checked: beyond ``limit_bytes`` they are cut, and each makes its own pass."""
    from lectern.config import BROADCAST_LIMIT_BYTES
    n = cents.count()
    if not n:
        return
    dim = len(cents.select(vec_col).first()[0])
    n_groups = -(-n // max(1, (limit_bytes or BROADCAST_LIMIT_BYTES) // (8 * max(dim, 1))))
    c = cents.select(F.col("topic_id").cast("int"), vec_col)
    for g in range(n_groups):
        t = c.where(F.pmod(F.xxhash64("topic_id"), F.lit(n_groups)) == g).orderBy("topic_id").toArrow()
        if t.num_rows:
            mat = t.column(vec_col).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            yield t.column("topic_id").to_numpy(), mat.astype(np.float64).reshape(t.num_rows, -1)


def _over_groups(vectors: DataFrame, cents: DataFrame, fn, id_col: str, vec_col: str,
                 limit_bytes: int | None) -> tuple[DataFrame, int]:
    """The rows that ``fn`` makes of every group, and how many groups there are.
    The cosine of a vector without length is null."""
    schema = f"{id_col} long, topic_id int, cosine double"
    out, n = vectors.sparkSession.createDataFrame([], schema), 0
    for ids, mat in _centroid_groups(cents, vec_col, limit_bytes):
        part = vectors.select(id_col, vec_col).mapInArrow(fn(ids, mat, id_col, vec_col), schema)
        out, n = (part if not n else out.unionByName(part)), n + 1
    cosine = F.when(~F.isnan("cosine"), F.round("cosine", PROB_DIGITS))
    return out.withColumn("cosine", cosine), n


def centroid_scores(vectors: DataFrame, cents: DataFrame, id_col: str = "article_id",
                    vec_col: str = "embedding", limit_bytes: int | None = None) -> DataFrame:
    """Cosine of every vector to every topic centroid, (id, topic_id, cosine)."""
    return _over_groups(vectors, cents, _centroid_scores_fn, id_col, vec_col, limit_bytes)[0]


def _nearest_fn(ids: np.ndarray, cmat: np.ndarray, id_col: str, vec_col: str):
    """The nearest centroid of each vector, ties to the lower id."""
    cn = np.sqrt((cmat * cmat).sum(axis=1))

    def run(batches):
        for b in batches:
            n = b.num_rows
            if n == 0:
                continue
            mat = b.column(vec_col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
            vn = np.sqrt((mat * mat).sum(axis=1))
            with np.errstate(invalid="ignore", divide="ignore"):
                sims = (mat @ cmat.T) / (vn[:, None] * cn[None, :])
            best = np.where(np.isnan(sims), -2.0, np.round(sims, PROB_DIGITS)).argmax(axis=1)
            yield pa.RecordBatch.from_pydict({
                id_col: b.column(id_col), "topic_id": pa.array(ids[best].astype(np.int32)),
                "cosine": pa.array(sims[np.arange(n), best], type=pa.float64())})
    return run


def assign_topics(vectors: DataFrame, cents: DataFrame, threshold: float = 0.1,
                  id_col: str = "article_id", limit_bytes: int | None = None) -> DataFrame:
    """M7: nearest centroid by cosine; below ``threshold`` -> -1; ties to the lower id.

    The centroids travel with the tasks in one matrix, as many as there are
    topics; where that is not small, ``limit_bytes`` cuts it into passes."""
    # one row per vector and centroid group leaves a task; a single group needs no shuffle
    near, groups = _over_groups(vectors, cents, _nearest_fn, id_col, "embedding", limit_bytes)
    if groups > 1:
        near = near.groupBy(id_col).agg(F.max_by(F.struct("topic_id", "cosine"), F.struct(
            "cosine", (-F.col("topic_id")).alias("nt"))).alias("b")).select(id_col, "b.*")
    return near.select(id_col, F.when(F.col("cosine") >= threshold, F.col("topic_id"))
                       .otherwise(F.lit(OUTLIER_TOPIC_ID)).cast("int").alias("topic_id"),
                       F.col("cosine").alias("score"))


def centroid_probabilities(scores: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Share of positive centroid similarity: max(cos, 0) / sum over topics."""
    pos = F.greatest(F.col("cosine"), F.lit(0.0))
    w = Window.partitionBy(id_col)
    tot = F.sum(pos).over(w)
    return scores.select(id_col, "topic_id",
                         F.round(F.when(tot > 0, pos / tot).otherwise(F.lit(0.0)), PROB_DIGITS).alias("probability"))


# ------------------------------------------------------------------ A13


def ngrams(toks: Column, ngram_range=TOPIC_NGRAM_RANGE) -> Column:
    """n-grams of a token array, joined by one space.

    Built by zipping shifted slices, so no lambda reads the array itself:
    Catalyst may inline the array's expression, and inside a lambda it
    would be evaluated once per element."""
    lo, hi = ngram_range
    parts = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(toks)
            continue
        m = F.greatest(F.size(toks) - n + 1, F.lit(0))
        gram = F.slice(toks, 1, m)
        for k in range(1, n):
            gram = F.zip_with(gram, F.slice(toks, k + 1, m), lambda a, b: F.concat(a, F.lit(" "), b))
        parts.append(gram)
    return F.flatten(F.array(*parts))


def term_tokens(text: Column, stop_words=STOP_WORDS, min_len: int = 2) -> Column:
    stop = list(stop_words)
    return F.filter(tokens(text), lambda t: (F.length(t) >= min_len) & ~t.isin(stop))


def class_term_weights(docs: DataFrame, class_cols: list[str], text_col: str = "text",
                       ngram_range=TOPIC_NGRAM_RANGE, min_df: int = TOPIC_MIN_DF,
                       df_unit: str = "articles", stop_words=STOP_WORDS,
                       top_n: int | None = TOPIC_TOP_TERMS, doc_col: str = "article_id") -> DataFrame:
    """(class_cols..., term_rank, term, weight) top ``top_n`` per class.

    Terms are the n-grams that reach ``min_df``, which counts documents
    (``df_unit='articles'``) or classes (``'classes'``); ``counted_terms``
    forms only those that may reach it."""
    if df_unit not in ("articles", "classes"):
        raise ValueError("df_unit must be 'articles' or 'classes'")
    tf, n_classes = counted_terms(docs, class_cols, text_col, ngram_range, min_df, df_unit, stop_words)
    total = tf.agg(F.sum("count").alias("s")).first().s or 0
    avg_words = int(total / n_classes) if n_classes else 0
    # a row a class: written first, so that its size is known and the terms need not be shuffled to meet it
    class_total = written(tf.groupBy(*class_cols).agg(F.sum("count").alias("_ct")), "class_totals")
    wgt = tf.join(class_total, class_cols).withColumn("weight", F.round(
        F.col("count") / F.col("_ct") * F.log(1 + F.lit(float(avg_words)) / F.col("total")), PROB_DIGITS))
    w = Window.partitionBy(*class_cols).orderBy(F.desc("weight"), "term")
    out = wgt.withColumn("term_rank", F.row_number().over(w))
    if top_n is not None:
        out = out.where(F.col("term_rank") <= top_n)
    return out.select(*class_cols, "term_rank", "term", "weight")


def topic_labels(terms: DataFrame, n_words: int = 4) -> DataFrame:
    """A14: '<id>_<w1>_<w2>_<w3>_<w4>'; the outlier topic is 'outlier'."""
    g = terms.where(F.col("term_rank") <= n_words).groupBy("topic_id").agg(
        F.array_sort(F.collect_list(F.struct("term_rank", "term"))).alias("_t"))
    words = F.array_join(F.transform("_t", lambda s: s["term"]), "_")
    return g.select("topic_id", F.when(F.col("topic_id") == OUTLIER_TOPIC_ID, F.lit("outlier"))
                    .otherwise(F.concat(F.col("topic_id").cast("string"), F.lit("_"), words)).alias("label"))


# ------------------------------------------------------------------ M10, M11


def align_topics(old_terms: DataFrame, new_terms: DataFrame) -> DataFrame:
    """Mutual best matches by Jaccard overlap of top-term sets.

    Pairs are found by joining on shared terms, never by pairing all topics."""
    o = old_terms.select(F.col("topic_id").alias("old_id"), "term")
    n = new_terms.select(F.col("topic_id").alias("new_id"), "term")
    so = o.groupBy("old_id").count().withColumnRenamed("count", "_no")
    sn = n.groupBy("new_id").count().withColumnRenamed("count", "_nn")
    shared = o.join(n, "term").groupBy("old_id", "new_id").count().withColumnRenamed("count", "shared")
    j = (shared.join(so, "old_id").join(sn, "new_id")
         .withColumn("jaccard", F.round(F.col("shared") / (F.col("_no") + F.col("_nn") - F.col("shared")),
                                        PROB_DIGITS)))
    bo = Window.partitionBy("old_id").orderBy(F.desc("jaccard"), "new_id")
    bn = Window.partitionBy("new_id").orderBy(F.desc("jaccard"), "old_id")
    j = j.withColumn("_ro", F.row_number().over(bo)).withColumn("_rn", F.row_number().over(bn))
    return j.where((F.col("_ro") == 1) & (F.col("_rn") == 1)).select("old_id", "new_id", "shared", "jaccard")


def topic_parents(terms: DataFrame, sizes: DataFrame, threshold: float = 0.1) -> DataFrame:
    """parent = most similar strictly larger topic by cosine of term
    weights (ties to the lower id), if the cosine reaches ``threshold``."""
    t = terms.where(F.col("topic_id") != OUTLIER_TOPIC_ID).select("topic_id", "term", "weight")
    norms = t.groupBy("topic_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_n"))
    a = t.select(F.col("topic_id").alias("child"), "term", F.col("weight").alias("wa"))
    b = t.select(F.col("topic_id").alias("parent"), "term", F.col("weight").alias("wb"))
    dots = a.join(b, "term").where(F.col("child") != F.col("parent")) \
        .groupBy("child", "parent").agg(F.sum(F.col("wa") * F.col("wb")).alias("_d"))
    sz = sizes.select("topic_id", "size")
    cos = (dots.join(norms.select(F.col("topic_id").alias("child"), F.col("_n").alias("_nc")), "child")
           .join(norms.select(F.col("topic_id").alias("parent"), F.col("_n").alias("_np")), "parent")
           .join(sz.select(F.col("topic_id").alias("child"), F.col("size").alias("_sc")), "child")
           .join(sz.select(F.col("topic_id").alias("parent"), F.col("size").alias("_sp")), "parent")
           .where(F.col("_sp") > F.col("_sc"))
           .withColumn("similarity", F.round(F.col("_d") / (F.col("_nc") * F.col("_np")), PROB_DIGITS))
           .where(F.col("similarity") >= threshold))
    w = Window.partitionBy("child").orderBy(F.desc("similarity"), "parent")
    best = cos.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    kids = sz.where(F.col("topic_id") != OUTLIER_TOPIC_ID).select(F.col("topic_id").alias("child"))
    return kids.join(best.select("child", "parent", "similarity"), "child", "left").select(
        F.col("child").alias("topic_id"), F.col("parent").alias("parent_topic_id"), "similarity")


# ------------------------------------------------------------------ M5, M6, M8


def reduce_vectors(vectors: DataFrame, k: int = TOPIC_PCA_COMPONENTS, id_col: str = "article_id",
                   vec_col: str = "embedding"):
    """M5: centred PCA to min(k, n, d) components. Returns (model, reduced df)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector

    v = vectors.select(id_col, array_to_vector(F.col(vec_col)).alias("_v"))
    n = v.count()
    if n == 0:
        raise ValueError("there are no vectors to reduce")
    d = len(vectors.select(vec_col).first()[0])
    kk = min(k, n, d)
    if kk <= 0:
        raise ValueError(f"cannot reduce to {k} components")
    pipe = Pipeline(stages=[StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False),
                            PCA(k=kk, inputCol="_c", outputCol="reduced")])
    model = pipe.fit(v)
    return model, model.transform(v).select(id_col, "reduced")


def log_densities(gm, reduced: DataFrame, id_col: str = "article_id") -> DataFrame:
    """(id, log_density): the logarithm of the mixture's density at every vector."""
    parts = [(w, np.array(g["mean"].toArray()), np.array(g["cov"].toArray()))
             for w, g in zip(gm.weights, gm.gaussiansDF.collect())]             # as many as clusters
    roots = []
    for w, mean, cov in parts:
        factor = np.linalg.cholesky(cov + 1e-9 * max(np.trace(cov) / len(mean), 1e-9) * np.eye(len(mean)))
        roots.append((np.log(max(w, 1e-300)) - np.log(np.diag(factor)).sum() - 0.5 * len(mean) * np.log(2 * np.pi), mean, np.linalg.inv(factor)))

    def run(batches):
        for b in batches:
            x = b.column("v").flatten().to_numpy().reshape(b.num_rows, -1)
            logs = np.stack([c - 0.5 * (((x - m) @ r.T) ** 2).sum(axis=1) for c, m, r in roots], axis=1)
            top = logs.max(axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array((top[:, 0] + np.log(np.exp(logs - top).sum(axis=1))))],
                                             [id_col, "log_density"])
    from pyspark.ml.functions import vector_to_array
    rows = reduced.select(F.col(id_col).cast("long").alias(id_col), vector_to_array("reduced").alias("v"))
    return rows.mapInArrow(run, f"{id_col} long, log_density double")


def low_density(densities: DataFrame, share: float, accuracy: int = 10_000) -> DataFrame:
    """``densities`` with ``outlier``: is the log density below the quantile of ``share``. The
    quantile is a sketch that tasks fill and merge; no row is sorted."""
    cut = densities.agg(F.percentile_approx("log_density", share, accuracy)).first()[0] if share > 0 else None
    return densities.withColumn("outlier", F.col("log_density") < F.lit(cut) if cut is not None else F.lit(False))


def fit_topics(vectors: DataFrame, n_topics: int = 10, min_cluster_size: int = TOPIC_MIN_CLUSTER_SIZE,
               pca_k: int = TOPIC_PCA_COMPONENTS, seed: int = 42, id_col: str = "article_id", outlier_share: float = 0.0):
    """M6 (re-aimed): PCA then a Gaussian mixture; clusters below
    ``min_cluster_size`` become outliers (-1), and so does the ``outlier_share`` of
    vectors at which the mixture is least dense; ids renumbered by size desc.

    Returns (models, assignments, probabilities long form)."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import vector_to_array

    pca_model, reduced = reduce_vectors(vectors, pca_k, id_col)
    gmm = GaussianMixture(k=n_topics, seed=seed, featuresCol="reduced", probabilityCol="_p",
                          predictionCol="_c", maxIter=100)
    gm = gmm.fit(reduced)
    scored = gm.transform(reduced).select(id_col, "_c", vector_to_array("_p").alias("_p"))
    if outlier_share > 0:
        far = low_density(log_densities(gm, reduced, id_col), outlier_share).where("outlier").select(id_col, F.lit(True).alias("_far"))
        scored = written(scored.join(far, id_col, "left"), "topic_scores")
    else:
        scored = scored.withColumn("_far", F.lit(None).cast("boolean"))
    sizes = scored.where("_far is null").groupBy("_c").count()
    w = Window.orderBy(F.desc("count"), "_c")  # one row per cluster, at most n_topics rows
    ranked = sizes.withColumn("_new", F.when(F.col("count") >= min_cluster_size,
                                             F.row_number().over(w) - 1))
    keep = ranked.where(F.col("_new").isNotNull())
    remap = ranked.select("_c", F.coalesce(F.col("_new"), F.lit(OUTLIER_TOPIC_ID)).cast("int").alias("topic_id"))
    outlier = F.lit(OUTLIER_TOPIC_ID)
    primary = scored.join(F.broadcast(remap), "_c", "left").select(
        id_col, F.when(F.col("_far").isNull(), F.coalesce("topic_id", outlier)).otherwise(outlier).alias("topic_id"))
    long = scored.select(id_col, F.posexplode("_p").alias("_c", "probability")) \
        .join(F.broadcast(keep.select("_c", F.col("_new").cast("int").alias("topic_id"))), "_c") \
        .select(id_col, "topic_id", "probability")
    assignments = secondary_topics(primary.withColumnRenamed(id_col, "article_id"),
                                   long.withColumnRenamed(id_col, "article_id"))
    return {"pca": pca_model, "gmm": gm}, assignments, long


def fit_density_topics(vectors: DataFrame, eps: float, min_points: int, min_cluster_size: int = TOPIC_MIN_CLUSTER_SIZE,
                       pca_k: int = TOPIC_PCA_COMPONENTS, id_col: str = "article_id"):
    """M6 by density: PCA, then ``density_clusters`` in the reduced space.

    Returns (models, (id, topic_id, core))."""
    from pyspark.ml.functions import vector_to_array

    from lectern.operators.density import density_clusters
    pca_model, reduced = reduce_vectors(vectors, pca_k, id_col)
    rows = written(reduced.select(id_col, vector_to_array("reduced").alias("embedding")), "reduced")
    return {"pca": pca_model}, density_clusters(rows, eps, min_points, min_cluster_size, id_col)


def save_models(models: dict, path: str) -> None:
    """M8: write the fitted stack."""
    for name, m in models.items():
        m.write().overwrite().save(f"{path.rstrip('/')}/{name}")


def load_models(path: str) -> dict:
    from pyspark.ml import PipelineModel
    from pyspark.ml.clustering import GaussianMixtureModel
    return {"pca": PipelineModel.load(f"{path.rstrip('/')}/pca"),
            "gmm": GaussianMixtureModel.load(f"{path.rstrip('/')}/gmm")}
