"""Queries over near and exact repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsekit.llm.decontamination import contaminated
from lapsekit.llm.minhash import near_duplicates
from lapsekit.llm.registry import query, table
from lapsekit.llm.suffixes import without_repeats
from lapsekit.llm.vectors import near_vectors

OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
         ELSE [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] END) AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY ALL
), l AS (SELECT a, b FROM c WHERE 100 * i >= 80 * (na + nb - i)
), d AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, d.b FROM r JOIN d ON r.reach = d.a
)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM s JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY 1) m USING (doc_id)
"""


@query("op4_minhash_near_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)

OP7_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), r(vec_id, reach) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.reach = l.a
), m AS (SELECT vec_id, min(reach) AS component_id FROM r GROUP BY 1)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = m.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM m
"""


@query("op7_embedding_near_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_benchmark_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_suffix_array_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
