"""The operators of this folder as queries over the benchmark tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (bpe, centroids, exact, fim, htmltext, language, lm, mixing, quality, simhash, tokenfile, toxicity,
               voronoi)
from .common import Scratch

WORD_FILE = "word_bpe_49k.json"
BPE_FILE = "byte_bpe_50k.tiktoken"
Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path(BPE_FILE))
    return bpe.encode(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, with_ids=False)


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_documents(spark, sf_dir).select("doc_id", "text"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))


def op4_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path(WORD_FILE), encoding="utf-8") as definition:
        path = f"{Scratch(spark, 'tokens').root}/documents"
        tokenfile.write_token_file(_documents(spark, sf_dir), path, definition.read(), end_id=2)
    return tokenfile.read_token_file(spark, path)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir).select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        "doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    learned = labels.where(~language.held_out(F.col("doc_id"), 5))
    chain = toxicity.fit(docs, learned, ["low_quality", "toxic"])
    found = toxicity.predict(docs, chain)
    return found.select("doc_id", language.held_out(F.col("doc_id"), 5).alias("held_out"),
                        F.col("toxic_score").alias("score"), F.col("toxic_pred").alias("toxic"),
                        "low_quality_score", F.col("low_quality_pred").alias("low_quality"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"), 5)
    model = language.fit(docs.where(~out))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", language.held_out(F.col("doc_id"), 5).alias("held_out"), "lang_pred", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rules(_documents(spark, sf_dir).select("doc_id", "source", "text"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.exact_groups(_documents(spark, sf_dir).select("doc_id", "text"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.restore(fim.transform(_documents(spark, sf_dir)))
    return made.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
                       F.col("middle_units").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.fit(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return centroids.describe(found).withColumnRenamed("id", "vec_id")


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


OPERATORS: dict[str, Query] = {
    f.__name__: f for f in (op1_byte_bpe, op2_lm_score, op3_simhash_near_dedup, op4_token_file,
                            op5_mix_sources, op6_toxicity, op7_language_id, op8_quality_rules, op9_html_text, op10_exact_dedup,
                            op11_fill_in_middle, op12_centroid_clusters, op13_exact_top_k)
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return OPERATORS | {"pipeline": pipeline}


# --- SQL -------------------------------------------------------------------------------------------

OP5_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents
), s AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
), rounds AS (
  SELECT 0 AS i, 0.0::DOUBLE AS level, -1.0::DOUBLE AS before
  UNION ALL
  SELECT i + 1, (SELECT (sum(source_size) - coalesce(sum(3 * source_size) FILTER (WHERE 3 * source_size <= weight * level), 0))::DOUBLE
            / sum(weight) FILTER (WHERE source_size > 0 AND NOT (3 * source_size <= weight * level)) FROM s), level
  FROM rounds WHERE level > before
), t AS (
  SELECT *, least((3 * source_size)::DOUBLE, weight * (SELECT max(level) FROM rounds)) AS target FROM s
), p AS (
  SELECT d.*, source_size, target, coalesce(floor(target / nullif(source_size, 0)), 0) AS whole,
         target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size AS part,
         row_number() OVER (PARTITION BY d.source ORDER BY key, size) AS n
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), along AS (
  SELECT source, 0::BIGINT AS n, any_value(part) AS rest, false AS fits FROM p GROUP BY source
  UNION ALL
  SELECT p.source, p.n, CASE WHEN size <= rest THEN rest - size ELSE rest END, size <= rest
  FROM along a JOIN p ON p.source IS NOT DISTINCT FROM a.source AND p.n = a.n + 1
)
SELECT doc_id, size, source_size, target, (size * (whole + (part > 0 AND fits)::INT))::BIGINT AS taken
FROM p JOIN along a ON p.source IS NOT DISTINCT FROM a.source AND p.n = a.n
"""

OP10_SQL = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (
  SELECT doc_id, max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
         count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
         sha256(coalesce(text, '')) AS text_sha256
  FROM documents
)
"""


OP11_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), c AS (
  SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT *, substr(t, 1, least(a, b)) AS prefix, substr(t, least(a, b) + 1, abs(a - b)) AS middle,
         substr(t, greatest(a, b) + 1) AS suffix
  FROM c
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form != 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form != 'plain' THEN abs(a - b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _op12_round(i: int) -> str:
    """Assignment to the centroids c{i}, and the centroids after it."""
    return f"""
a{i} AS MATERIALIZED (
  SELECT r, k, dist FROM (
    SELECT r, k, v.ee - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e) AS dist
    FROM v, c{i} c
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY dist, k) = 1
), m{i} AS MATERIALIZED (
  SELECT k, list(x ORDER BY d) AS e
  FROM (SELECT k, d, floor(sum(x) / count(*)) AS x
        FROM (SELECT k, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM a{i} JOIN v USING (r)) GROUP BY k, d)
  GROUP BY k
), c{i + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m USING (k)
),"""


OP12_SQL = f"""
WITH v0 AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE {_FINITE} AND len(embedding) = 64
), v AS MATERIALIZED (
  SELECT *, list_inner_product(e, e) AS ee FROM v0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e
  FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, e FROM v ORDER BY h, e LIMIT 40)
), {''.join(map(_op12_round, range(6)))} s AS (
  SELECT k, sum(dist) AS cluster_inertia FROM a5 GROUP BY k
)
SELECT vec_id, k::INT AS cluster, dist::BIGINT AS distance, cluster_inertia::BIGINT AS cluster_inertia,
       (SELECT sum(dist) FROM a5)::BIGINT AS inertia,
       sha256(array_to_string(c5.e::BIGINT[], ',')) AS centroid_sha256
FROM a5 JOIN v USING (r) JOIN s USING (k) JOIN c5 USING (k)
"""

OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings WHERE {_FINITE}
)
SELECT query_id, rank::INT AS rank, vec_id, score::BIGINT AS score
FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score,
         row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id NULLS LAST) AS rank
  FROM v q JOIN v c ON q.r != c.r WHERE q.vec_id % 20 = 0
) WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_mix_sources": OP5_SQL, "op10_exact_dedup": OP10_SQL, "op11_fill_in_middle": OP11_SQL,
            "op12_centroid_clusters": OP12_SQL, "op13_exact_top_k": OP13_SQL}
