"""The registered queries of the corpus operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree_search, decontamination, licenses, lm_scoring, mixing, periodic_runs, quality, sharding, simhash, substring_dedup, token_counts, toxicity, url_filter
from .common import split_words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_log_frequency_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op2_likelihood_ratio_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_prefix_join_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_minhash_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_segment_tree_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs.withColumn("edits", token_counts.redactions()(F.col("text"))), carry=["doc_id"])


def op8_regression_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), carry=["page_id"])


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 16, carry=["doc_id"])


def op10_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])


def planted_periods(text: Column, doc_id: Column) -> Column:
    """The text, or for a tenth of the ids a text whose words repeat from some word on: both from the crc32 of the id.

    A null id has none. The words are a lambda's variable, so a text is split once.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % F.greatest(n, F.lit(1))
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.concat_ws(" ", F.transform(w, lambda x, i: F.when(i >= a, F.get(w, (a + (i - a) % p).cast("int"))).otherwise(x)))

    return F.when(h % 10 == 0, F.transform(F.array(split_words(text)), repeated)[0]).otherwise(text)


def op11_sparse_diagonal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_periods(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs.periodic_runs(docs, carry=["doc_id"])
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    told = F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256)
    top = F.col("strongest")
    milli = F.floor(1000 * top["length"] / top["period"]).cast("long")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"), top["length"].alias("length"), top["period"].alias("period"),
        milli.alias("exponent_milli"), told.alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_count_min_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_log_frequency_bloom_lm, op2_likelihood_ratio_quality, op3_prefix_join_decontamination, op4_multi_index_simhash, op5_compression_toxicity, op6_minhash_license_scan, op7_segment_tree_token_counts, op8_regression_url_filter, op9_feistel_shards, op10_fair_queue_mix, op11_sparse_diagonal_runs, op12_count_min_substring_dedup, op13_ball_tree_search)}

SQL: dict[str, str] = {}
SQL["op10_fair_queue_mix"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS sid FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(sid % 3 + 1)::INT]::DOUBLE AS w, (2 * total)::DOUBLE AS cap FROM s),
level(k, lam) AS (
  SELECT 0, 0.0::DOUBLE
  UNION ALL
  SELECT k + 1, new FROM (
    SELECT l.k, l.lam, (SELECT (1.5 * sum(total) - coalesce(sum(cap) FILTER (cap < w * l.lam), 0))::DOUBLE / sum(w) FILTER (NOT cap < w * l.lam) FROM w) AS new FROM level l) q
  WHERE new > lam),
t AS (SELECT source, sid, total, least(cap, w * (SELECT max(lam) FROM level)) AS target FROM w),
q AS (
  SELECT d.doc_id, d.size, d.u, t.sid, t.total, t.target, p.pass,
         CASE WHEN t.target > 0 THEN (sum(d.size) OVER (PARTITION BY t.sid, p.pass ORDER BY d.u, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) + p.pass * t.total)::DOUBLE / t.target ELSE 0 END AS finish
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) p(pass)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, sid, pass, u, doc_id, size ROWS UNBOUNDED PRECEDING) AS running FROM q)
SELECT doc_id, size, total AS source_size, target, count(*) FILTER (running <= (SELECT floor(1.5 * sum(total)) FROM s))::INT AS times,
       sum(CASE WHEN running <= (SELECT floor(1.5 * sum(total)) FROM s) THEN size ELSE 0 END)::BIGINT AS taken
FROM r GROUP BY doc_id, size, total, target, sid, u
"""

SQL["op3_prefix_join_decontamination"] = r"""
WITH lowered AS (
  SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT kind, id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM lowered),
item AS (SELECT id, w, len(w) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM split WHERE kind = 'b' AND id IS NOT NULL AND len(w) > 0),
win AS (SELECT DISTINCT id::VARCHAR AS item, w[i : i + least(n, 13) - 1] AS ws, least(n, 13) AS l FROM item),
lens AS (SELECT DISTINCT l FROM win),
place AS (SELECT s.id, s.w, lens.l, unnest(range(1, len(s.w) - lens.l + 2)) AS p FROM split s, lens WHERE kind = 'd' AND len(s.w) >= lens.l),
occ AS (SELECT place.id, place.p, place.l, win.item FROM place JOIN win ON win.l = place.l AND win.ws = place.w[place.p : place.p + place.l - 1]),
hit AS (SELECT id, count(DISTINCT pos) AS n_hit FROM (SELECT id, unnest(range(p, p + l)) AS pos FROM occ) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM (SELECT DISTINCT id, item FROM occ) GROUP BY id)
SELECT s.id AS doc_id, len(s.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(s.w) AS contaminated
FROM split s LEFT JOIN hit ON hit.id = s.id LEFT JOIN named ON named.id = s.id WHERE s.kind = 'd'
"""

_TEMPLATES = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in t)) for t in licenses.TEMPLATES)
SQL["op6_minhash_license_scan"] = rf"""
WITH t(license, text) AS (VALUES {_TEMPLATES}),
x AS (SELECT 'd' AS kind, doc_id AS id, NULL AS license, text FROM documents UNION ALL SELECT 't', NULL, license, text FROM t),
s AS (SELECT kind, id, license, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM x),
g AS (SELECT *, list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i : i + 4], ' ')) AS grams FROM s),
k AS (SELECT license, list_distinct(grams) AS own, len(list_distinct(grams)) AS m FROM g WHERE kind = 't'),
c AS (SELECT g.id, g.grams, k.license, k.own, k.m, greatest(len(g.grams) - k.m, 0) AS last FROM g JOIN k ON list_has_any(g.grams, k.own) WHERE g.kind = 'd'),
p AS (SELECT id, license, own, m, grams, unnest(range(0, last + 1)) AS a FROM c),
f AS (SELECT id, license, len(list_intersect(list_distinct(grams[a + 1 : a + m]), own)) / m::DOUBLE AS share FROM p),
h AS (SELECT id, count(DISTINCT license) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS l, max(share) AS b FROM f WHERE share >= 0.8 GROUP BY id)
SELECT s.id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(l, '') AS licenses, coalesce(b, 0)::DOUBLE AS best_share
FROM s LEFT JOIN h ON h.id = s.id WHERE s.kind = 'd'
"""

SQL["op12_count_min_substring_dedup"] = r"""
WITH s AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, array_to_string(w[i : i + 19], ' ') AS win, i FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM s)),
f AS (SELECT doc_id, i, min(struct_pack(d := doc_id, i := i)) OVER (PARTITION BY win) AS first FROM p),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM f WHERE first.d <> doc_id OR first.i <> i),
c AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id)
SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, j: gone IS NULL OR NOT list_contains(gone, j)), ' ')) AS kept_sha256
FROM s LEFT JOIN c ON c.doc_id = s.doc_id
"""

SQL["op13_ball_tree_search"] = r"""
WITH x AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
s AS (SELECT kind, id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []) AS t FROM x),
q AS (SELECT id AS item_id, term, count(*) AS times FROM (SELECT id, unnest(t) AS term FROM s WHERE kind = 'b') GROUP BY 1, 2),
g AS (SELECT count(*) AS n_docs, sum(len(t)) AS total FROM s WHERE kind = 'd' AND len(t) > 0),
f AS (SELECT id AS doc_id, n, term, count(*) AS tf FROM (SELECT id, len(t) AS n, unnest(t) AS term FROM s WHERE kind = 'd') WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, g GROUP BY term),
v AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total)) AS x FROM f, g),
p AS (SELECT item_id, doc_id, sum(times * w * x)::BIGINT AS score FROM q JOIN w USING (term) JOIN v USING (term) GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM p WHERE score > 0) WHERE rank <= 20
"""
