"""The registered queries of the numbered operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.llm import html_text, langid, toxicity
from wordspan.llm.bpe import encode_documents
from wordspan.llm.common import remainder, table
from wordspan.llm.divergence import divergence
from wordspan.llm.embed_dedup import near_vectors
from wordspan.llm.exact_dedup import exact_dedup
from wordspan.llm.hard_negatives import mine
from wordspan.llm.licenses import scan_documents
from wordspan.llm.ngram_join import near_documents
from wordspan.llm.packing import pack_documents
from wordspan.llm.sharding import shard_documents
from wordspan.llm.token_counts import count_edited


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digest_only=True)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents"))


def op7_histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return sharded.select("doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, remainder("doc_id", 4) != 2)
    return langid.predict(docs, model).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_edit_aware_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_edited(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents")).drop("spans")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_histogram_sharding": op7_histogram_sharding,
    "op8_language_id": op8_language_id,
    "op9_edit_aware_token_counts": op9_edit_aware_token_counts,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_license_scan": op12_license_scan,
    "op13_source_divergence": op13_source_divergence,
}

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
w AS (SELECT h, count(*) AS group_size, max(n) AS most FROM d GROUP BY h),
k AS (SELECT d.h, min(d.doc_id) AS keep_id FROM d JOIN w ON d.h = w.h AND d.n = w.most GROUP BY d.h)
SELECT d.doc_id, k.keep_id, w.group_size, d.doc_id = k.keep_id AS kept, d.h AS text_sha256
FROM d JOIN w ON d.h = w.h JOIN k ON d.h = k.h
"""

OP4_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.k <> b.k AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT y, c FROM reached JOIN links ON vec_id = x),
n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x), least AS (SELECT vec_id, min(c) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN least USING (vec_id) LEFT JOIN n ON vec_id = x
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(list_zip(w, w[2:], w[3:], w[4:], w[5:])[:len(w) - 4], lambda z: concat_ws(' ', z[1], z[2], z[3], z[4], z[5]))) END AS g FROM w),
u AS (SELECT doc_id, unnest(g) AS h FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * m >= 80 * (len(a.g) + len(b.g) - m)),
reached AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT y, c FROM reached JOIN links ON doc_id = x),
least AS (SELECT doc_id, min(c) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id FROM s JOIN least USING (doc_id)
"""

OP11_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, c.id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.id <> c.id AND a.id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank,
  s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
t AS (SELECT k, lang, source, term, count(*) AS n FROM (SELECT k, lang, source, unnest(terms) AS term FROM d) GROUP BY ALL),
kept AS (SELECT lang, term, sum(n)::HUGEINT AS c FROM t GROUP BY lang, term HAVING count(*) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, sum(n)::HUGEINT AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT d.lang, d.source, coalesce((SELECT sum(c) FROM own WHERE own.lang = d.lang AND own.source = d.source), 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) d),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(own.c, 0) AS c, 1 + 1000000000 * (coalesce(own.c, 0) + 1) // (g.n + l.v) AS p,
    1 + 1000000000 * (kept.c + 1) // (l.n + l.v) AS q
  FROM g JOIN kept USING (lang) JOIN l USING (lang) LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = kept.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y USING (lang, term) WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
term AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term))
WHERE part = 'pair' OR rank <= 200
"""

ORACLE_SQL: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op4_embedding_near_dedup": OP4_SQL, "op6_ngram_jaccard_join": OP6_SQL, "op11_hard_negatives": OP11_SQL, "op13_source_divergence": OP13_SQL}
