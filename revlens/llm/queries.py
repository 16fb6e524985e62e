"""The queries of this sub-package: one thin query per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import (bpe, divergence, exact_stream, hard_negatives, language_id, mixing, near_omh, near_vectors,
                         pii, quality, secrets, suffix_tree_lm, url_filter)
from revlens.llm.common import crc_mod, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def bpe_digests(docs: DataFrame) -> DataFrame:
    path = bpe.rank_file()
    coded = bpe.decode(bpe.encode(docs, path), path)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"))


ORACLES["op6_stream_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


@query
def op6_stream_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_stream.dedup(read(spark, sf_dir, "documents")).rows
    return rows.select("doc_id", "keep_id", "group_size", "kept",
                       F.col("digest").alias("text_sha256"))


ORACLES["op2_temperature_mixing"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^\t-\r ]+')) AS n_tokens
  FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS source_tokens FROM t GROUP BY source HAVING sum(n_tokens) > 0),
p AS (
  SELECT *, source_tokens::DOUBLE / sum(source_tokens) OVER () AS share,
         sum(source_tokens) OVER () AS total, count(*) OVER () AS n
  FROM s),
e AS (
  SELECT k, k / 65536::DOUBLE AS a, sum(exp(k / 65536::DOUBLE * ln(share))) AS z,
         sum(exp(k / 65536::DOUBLE * ln(share)) * ln(share)) AS u,
         max(exp(k / 65536::DOUBLE * ln(share)) / source_tokens) AS top,
         any_value(total) AS total, any_value(n) AS n
  FROM p, range(0, 65537) AS r(k) GROUP BY k),
x AS (
  SELECT greatest(max(k) FILTER (ln(z) - a * u / z >= 0.95::DOUBLE * ln(n) - 1e-9::DOUBLE),
                  min(k) FILTER (top / z * total <= 4 + 1e-9::DOUBLE)) / 65536::DOUBLE AS a
  FROM e),
w AS (SELECT p.*, a, exp(a * ln(share)) / sum(exp(a * ln(share))) OVER () AS weight FROM p, x),
b AS (SELECT source, source_tokens, CASE WHEN a = 1 THEN source_tokens ELSE floor(total * weight + 1e-6::DOUBLE)::BIGINT END AS source_budget FROM w),
d AS (
  SELECT t.*, b.source_tokens, b.source_budget, b.source_budget // b.source_tokens AS epochs,
         b.source_budget % b.source_tokens AS rest
  FROM t JOIN b USING (source) WHERE source_budget > 0),
r AS (SELECT *, unnest(range(0, epochs + 1)) AS epoch FROM d),
h AS (SELECT *, md5('mix|' || epoch || '|' || doc_id) AS draw_key FROM r),
c AS (
  SELECT *, (sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY draw_key))::BIGINT AS through,
         (sum(n_tokens) OVER (PARTITION BY source, epoch, draw_key))::BIGINT AS own
  FROM h),
q AS (SELECT *, epoch * source_tokens + through AS position FROM c WHERE epoch < epochs OR through - own < rest)
SELECT doc_id, source, epoch, (greatest(least(position, source_budget) - 1, 0) * 64) // source_budget AS block,
       position, n_tokens, draw_key
FROM q"""


@query
def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), mixing.MixSpec(crossing=True)).draws


@query
def op7_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    spec = quality.QualitySpec()
    scored = quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels"), spec))
    return scored.select("doc_id", (crc_mod() == 0).alias("held_out"),
                         F.col(quality.SCORE).alias("score"),
                         (F.col(quality.SCORE) >= spec.threshold).cast("int").alias("predicted"))


@query
def op9_order_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_omh.classes(read(spark, sf_dir, "documents").select("doc_id", "text")).rows
    return rows.select("doc_id", "class_id", "kept")


@query
def op3_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.links(read(spark, sf_dir, "embeddings"))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def span_digest(found: DataFrame, kinds) -> DataFrame:
    """Counts per kind, the digest of the base spans and all spans as text."""
    def joined(col):
        return F.array_join(F.transform(F.col(col), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, kinds), F.sha2(joined("base_spans"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))


@query
def op4_secret_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(secrets.scan(read(spark, sf_dir, "documents")), secrets.KINDS)


@query
def op1_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(pii.find(read(spark, sf_dir, "documents").select("doc_id", "text")), pii.KINDS)


@query
def op8_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spec = suffix_tree_lm.TreeSpec()
    model = suffix_tree_lm.fit(docs.filter(crc_mod() != 1).select("text"), spec)
    scored = suffix_tree_lm.score(docs, model, spec)
    return scored.select("doc_id", (crc_mod() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


ORACLES["op11_triangle_negatives"] = """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS whole
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.whole, b.whole)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


@query
def op11_triangle_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = F.col("vec_id") % 7 == 0
    label = F.when(turned, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 50 == 0, label=label)


ORACLES["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
         coalesce(source, '') AS source
  FROM documents),
w AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
kl AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT lang, source, any_value(coalesce(v, 0)) AS v, coalesce(sum(c.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN kl USING (lang) LEFT JOIN c USING (lang, source)
  GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, k.term, c.n IS NOT NULL AS held,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.n + 5 * g.v) AS p,
         1 + 1000000000::HUGEINT * (k.n + 5) // (kl.n + 5 * kl.v) AS q
  FROM g JOIN kl USING (lang) JOIN k USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE held AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM f QUALIFY part = 'pair' OR rank <= 50"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


@query
def op13_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(modulus=4) == 2
    prototypes = language_id.learn(docs.filter(~held_out).select("text", "lang"))
    found = language_id.predict(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
