"""The registered queries of the subpackage: thin digests of its operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propspark.llm import (anchors, bagminhash, bpe, exact_sort, license_rules, lm_bloom, secret_models, shards, spaced_seeds,
                           square_runs, toxicity, url_rules, zone_clusters)
from propspark.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op4_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the identifier that stays for its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Only the identifier rides along; the text itself is the sort key.
    out = exact_sort.exact_groups(docs, carry=["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


# ------------------------------------------------------------ fixed values
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# -------------------------------------------------------- end fixed values


@register("op1_url_rules", """
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
           FROM pages),
u AS (SELECT page_id,
        translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path FROM r),
j AS (SELECT page_id, host, path, CASE
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule FROM u)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM j""")
def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the five rules; unmatched urls are allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


@register("op10_shards")
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    out = shards.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@register("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word-level vocabulary."""
    return bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                            carry=["doc_id"], outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


@register("op5_decontamination")
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it overlaps."""
    return spaced_seeds.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op6_licences", r"""
WITH s AS (SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '[.!?;:]*\s*\n\s*|[.!?;:]+\s+')) AS s,
                  generate_subscripts(regexp_split_to_array(coalesce(text, ''), '[.!?;:]*\s*\n\s*|[.!?;:]+\s+'), 1) - 1 AS pos
           FROM documents),
n AS (SELECT doc_id, pos, trim(regexp_replace(regexp_replace(lower(s), '\.$', ''), '[^a-z0-9.]+', ' ', 'g')) AS s FROM s),
m AS (SELECT doc_id, pos, CASE s
        WHEN 'licensed under the apache license version 2.0' THEN 'Apache-2.0'
        WHEN 'released under the mit license' THEN 'MIT'
        WHEN 'licensed under the mit license' THEN 'MIT'
        WHEN 'this work is licensed under the gnu general public license version 3' THEN 'GPL-3.0'
        WHEN 'licensed under cc by nc 4.0' THEN 'CC-BY-NC-4.0'
        WHEN 'licensed under cc by 4.0' THEN 'CC-BY-4.0'
        WHEN 'all rights reserved' THEN 'proprietary' END AS licence FROM n)
SELECT doc_id, licence, count(*)::INT AS n_matches, min(pos)::INT AS first_sentence
FROM m WHERE licence IS NOT NULL GROUP BY doc_id, licence""")
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in every document."""
    return license_rules.scan_licences(table(spark, sf_dir, "documents"))


@register("op7_repeats", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM s) WHERE n > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
k AS (SELECT d.doc_id, len(w) AS n, coalesce(len(gone), 0) AS m,
             CASE WHEN gone IS NULL THEN w
                  ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, n AS n_words, m AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k""")
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 20 words that start earlier."""
    return anchors.remove_repeats(table(spark, sf_dir, "documents"), outputs=("kept_sha256",))


@register("op2_near_dedup")
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op8_lm_scores")
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of the documents learnt from."""
    return lm_bloom.score_texts(table(spark, sf_dir, "documents"))


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model of the labelled rows outside fold 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model, carry=["doc_id"])
    return scored.select("doc_id", (lm_bloom.fold(F.col("doc_id")) == 0).alias("held_out"),
                         F.col("toxicity").alias("score"),
                         F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).alias("predicted"))


@register("op11_secrets")
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets by pattern and by the Markov models."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_models.find_secrets(docs, secret_models.fit(docs), carry=["doc_id"],
                                      outputs=("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"))


@register("op12_runs", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
                  list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT) AS digits FROM documents),
h AS (SELECT doc_id, w, len(w) AS n, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], digits),
        lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]),
                                 lambda x, k: xor(x // 2, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)))) AS h FROM d),
p AS (SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a, CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p FROM h),
t AS MATERIALIZED (SELECT doc_id, n, CASE WHEN h % 10 <> 0 OR n = 0 THEN w
             ELSE list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM p),
s AS (SELECT doc_id, n, i, hash(w[i + 1:i + 5]) AS s FROM (SELECT *, unnest(range(n - 4)) AS i FROM t WHERE n >= 6)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM s x JOIN s y ON x.doc_id = y.doc_id AND x.s = y.s
      WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
g AS (SELECT doc_id, q, min(i) AS a, max(i) + 5 + q - min(i) AS n FROM (
        SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM m) GROUP BY doc_id, q, g),
r AS MATERIALIZED (SELECT doc_id, a, n, min(q) AS q FROM g WHERE n >= greatest(6, 4 * q) GROUP BY doc_id, a, n),
k AS (SELECT doc_id, count(*) AS n_runs, arg_min({'a': a, 'n': n, 'q': q}, {'n': -n, 'a': a, 'q': q}) AS b,
             string_agg(a || ',' || n || ',' || q || chr(10), '' ORDER BY a, q) AS runs,
             flatten(list(range(a + q, a + n))) AS gone FROM r GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b.a AS start, b.n AS length, b.q AS period, 1000 * b.n // b.q AS exponent_milli,
       sha256(coalesce(runs, '')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i - 1)) END, ' '))
         AS collapsed_sha256
FROM t LEFT JOIN k USING (doc_id)""")
def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs, a tenth of the documents made periodic first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10), F.col("n")
    parted = docs.withColumn("w", F.when(h % 10 == 0, words)).withColumn("n", F.size("w").cast("bigint"))
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    parted = parted.withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(
        "w", (1 + F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))).cast("int")))
    text = F.when(n > 0, F.array_join(made, " ")).otherwise(F.col("text"))
    return square_runs.find_runs(parted.select("doc_id", text.alias("text")), carry=["doc_id"],
                                 outputs=("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))


def _lloyd_sql(rounds: int = 5) -> str:
    """Lloyd's rounds on integer vectors, one pair of views per round."""
    near = """a{r} AS MATERIALIZED (SELECT vec_id, any_value(q) AS q, arg_min(c, d * 64 + c) AS c, min(d) AS d FROM (
  SELECT v.vec_id, v.q, k.c, list_sum(list_transform(list_zip(v.q, k.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM v, c{r} k) GROUP BY vec_id)"""
    move = """c{s} AS MATERIALIZED (SELECT k.c, coalesce(m.q, k.q) AS q FROM c{r} k LEFT JOIN (
  SELECT c, list((t - ((t % n) + n) % n) // n ORDER BY j) AS q FROM (
    SELECT c, j, sum(q[j])::BIGINT AS t, count(*) AS n FROM a{r}, range(1, 65) g(j) GROUP BY c, j) GROUP BY c) m USING (c))"""
    parts = ["""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, q FROM v
  ORDER BY sha256('2:' || vec_id) LIMIT 40)"""]
    for r in range(rounds):
        parts += [near.format(r=r), move.format(r=r, s=r + 1)]
    parts.append(near.format(r=rounds))
    return f"""WITH {', '.join(parts)}
SELECT a.vec_id, a.c::INT AS cluster, a.d AS distance, sum(a.d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
       sum(a.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(k.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} k ON k.c = a.c"""


@register("op13_clusters", _lloyd_sql())
def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's nearest of 40 centroids after five rounds."""
    return zone_clusters.cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
