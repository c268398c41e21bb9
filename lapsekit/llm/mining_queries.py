"""Queries over packed sequences, hard negatives and collocations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lapsekit.llm import collocations, negatives, packing
from lapsekit.llm.registry import query, table


@query("op11_best_fit_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), with_ids=False))


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
), n AS (
  SELECT p.*, s.other AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


@query("op12_hard_negative_mining", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", label))


_GRAMS = " UNION ALL ".join(
    f"SELECT lang, {k} AS size, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM "
    f"(SELECT lang, w, unnest(range(1, len(w) + 2 - {k})) AS i FROM p WHERE len(w) >= {k})"
    for k in range(1, 6)
)
OP13_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d
), g AS ({_GRAMS}
), f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), n AS (SELECT lang, count(*) AS n FROM g WHERE size = 1 GROUP BY lang
), c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1
), s AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n.n,
    CAST(1000::HUGEINT * c.a * n.n // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM c JOIN n ON c.lang = n.lang
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
), t AS (
  SELECT * FROM s WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = s.lang AND length(f.phrase) > length(s.phrase) AND f.size > 1 AND f.f >= s.a
      AND contains(' ' || f.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM t QUALIFY rank <= 2000
"""


@query("op13_phrase_collocations", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
