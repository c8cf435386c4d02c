"""Registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (decontaminate, exact_dedup, filter_audit, jaccard_join, kd_sharding, language_id, license_scan, pii,
                         quality, sentence_pieces, source_divergence, substring_dedup, url_filter)
from lectern.llm.common import documents, shared_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: A-Z lower-cased in DuckDB, all else unchanged.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir).withColumn(
        "text_sha256", F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    return exact_dedup.exact_dedup(d).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP1_SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window g as (partition by coalesce(text, ''))
"""

def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP4_SQL = rf"""
with d as (select row_number() over () as r, doc_id,
                  regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
     b as (select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark),
     bw as (select distinct item_id, least(10, len(ws)) as n,
                   array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') as g
            from b, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as t(i) where len(ws) > 0),
     dw as (select r, n, i, array_to_string(ws[i:i + n - 1], ' ') as g
            from d, (select distinct n from bw), unnest(range(1, len(ws) - n + 2)) as t(i)),
     hit as (select r, n, i, item_id from dw join bw using (n, g)),
     cover as (select r, count(distinct w) as n_hit from hit, unnest(range(i, i + n)) as t(w) group by r),
     found as (select r, list_sort(list(distinct item_id::varchar)) as ids from hit group by r)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(len(ids), 0) as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join cover using (r) left join found using (r)
"""


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, pii.BASE_KINDS),
        F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


OP6_SQL = rf"""
with recursive d as (select row_number() over () as r, doc_id,
                  regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as ws from documents),
     s as (select distinct r, array_to_string(ws[i:i + 4], ' ') as g
           from d, unnest(range(1, greatest(len(ws) - 3, 2))) as t(i) where len(ws) > 0),
     n as (select r, count(*) as n from s group by r),
     pair as (select a.r as a, b.r as b, count(*) as m from s a join s b using (g) where a.r < b.r group by a.r, b.r),
     link as (select a, b from pair join n x on x.r = a join n y on y.r = b
              where 100 * m >= 80 * (x.n + y.n - m)),
     edge as (select a, b from link union all select b, a from link),
     reach as (select r as a, r as b from d union select reach.a, edge.b from reach join edge on reach.b = edge.a),
     comp as (select a as r, min(doc_id) as component_id from reach join d on d.r = reach.b group by a)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from d left join n using (r) join comp using (r)
"""


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (substring_dedup.remove_repeats(documents(spark, sf_dir))
            .select("doc_id", "n_words", "n_removed",
                    F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")))


OP7_SQL = r"""
with d as (select row_number() over () as r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
     win as (select r, i, array_to_string(ws[i:i + 34], ' ') as g
             from d, unnest(range(1, len(ws) - 33)) as t(i)),
     twice as (select g from win group by g having count(*) > 1),
     gone as (select distinct r, p from win semi join twice using (g), unnest(range(i, i + 35)) as t(p)),
     word as (select r, p, ws[p] as w from d, unnest(range(1, len(ws) + 1)) as t(p)),
     kept as (select r, string_agg(w, ' ' order by p) as k, count(*) as n from word anti join gone using (r, p) group by r)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from d left join kept using (r)
"""

def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"))


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_sharding.shard_documents(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = language_id.held_out(F.col("doc_id"))
    d = documents(spark, sf_dir)
    model = language_id.fit(d.filter(~held & F.col("doc_id").isNotNull()))
    return language_id.identify(d.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(documents(spark, sf_dir))


def op10_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_and_decode(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = quality.held_out(F.col("doc_id"))
    stats = shared_table(quality.statistics(documents(spark, sf_dir).select("doc_id", "text")), "statistics")
    model = quality.fit(stats.filter(~held), _table(spark, sf_dir, "labels"))
    return quality.score_documents(stats, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


OP12_SQL = r"""
with t as (select coalesce(source, '') as part, doc_id, coalesce(text, '') as x from documents),
     w as (select *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by x) as least from t),
     l as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
     d as (select part, (len(ws) < 50)::int + 2 * (100 * len(list_distinct(ws)) < 65 * len(ws))::int
                  + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x))::int
                  + 8 * regexp_matches(x, '[#$%&*|]')::int + 16 * coalesce(doc_id > least, false)::int as m,
                  coalesce(good, false)::int as good, coalesce(toxic, false)::int as toxic
           from w left join l using (doc_id)),
     c as (select part, m, count(*) as n, sum(good) as good, sum(toxic) as toxic from d group by part, m),
     state as (select part, s, sum(case when m & s = 0 then n else 0 end) as n,
                      sum(case when m & s = 0 then good else 0 end) as good,
                      sum(case when m & s = 0 then toxic else 0 end) as toxic
               from c, range(32) as r(s) group by part, s),
     f as (select i, chr(65 + i::int) as letter, (1 << i)::bigint as bit from range(5) as r(i)),
     o as (select [a.i, b.i, c.i, d.i, e.i] as p, concat(a.letter, b.letter, c.letter, d.letter, e.letter) as filter_order
           from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31
             and len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
     step as (select filter_order, k as step, (1 << p[k])::bigint as bit,
                     list_sum([1 << i for i in p[1:k]])::bigint as after from o, range(1, 6) as r(k)),
     run as (select y.part, filter_order, step, bit, y.n as kept, x.n - y.n as removed, x.good - y.good as good_lost,
                    x.toxic - y.toxic as toxic_lost
             from step join state y on y.s = after join state x on x.s = after - bit and x.part = y.part),
     shap as (select part, bit, sum(removed) as shapley from run group by part, bit)
select r.part, r.filter_order, r.step::int as step, r.kept::bigint as kept, r.removed::bigint as removed,
       (nothing.n - own.n - r.removed)::bigint as redundant, (rest.n - every.n)::bigint as unique_fails,
       r.good_lost::bigint as good_lost, r.toxic_lost::bigint as toxic_lost, shapley::bigint as shapley
from run r join shap using (part, bit)
     join state nothing on nothing.part = r.part and nothing.s = 0 join state own on own.part = r.part and own.s = bit
     join state rest on rest.part = r.part and rest.s = 31 - bit join state every on every.part = r.part and every.s = 31
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.source_divergences(documents(spark, sf_dir))


OP13_SQL = rf"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                  regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents),
     g as (select distinct lang, source from d),
     w as (select r, lang, source, unnest(ws) as term from d),
     kept as (select lang, term, count(*)::hugeint as c from w group by lang, term having count(distinct r) >= 3),
     cnt as (select lang, source, term, count(*)::hugeint as c from w semi join kept using (lang, term)
             group by lang, source, term),
     ln as (select lang, count(*)::hugeint as v, sum(c)::hugeint as n from kept group by lang),
     gn as (select lang, source, coalesce(sum(c), 0)::hugeint as n from g left join cnt using (lang, source)
            group by lang, source),
     p as (select gn.lang, gn.source, term, coalesce(cnt.c, 0) as c,
                  1 + (1000000000::hugeint * (coalesce(cnt.c, 0) + 1)) // (gn.n + ln.v) as p,
                  1 + (1000000000::hugeint * (kept.c + 1)) // (ln.n + ln.v) as q
           from gn join ln using (lang) join kept using (lang) left join cnt using (lang, source, term)),
     sums as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
              from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source
              group by a.lang, a.source, b.source),
     found as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(value, 0)::bigint as value
               from g a join g b on a.lang = b.lang and a.source <> b.source
                    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
               union all
               select lang, source, 'term', term, ((p - q) * (p - q) // q)::bigint from p where c > 0 and p > q),
     ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= 200
"""


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_kd_sharding": op3_kd_sharding,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_personal_data": op5_personal_data,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_language_id": op8_language_id,
    "op9_license_scan": op9_license_scan,
    "op10_sentencepiece_sampling": op10_sentencepiece_sampling,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_filter_audit": op12_filter_audit,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op4_benchmark_decontamination": OP4_SQL,
    "op6_ngram_jaccard_join": OP6_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op12_filter_audit": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
