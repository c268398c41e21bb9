"""The WARC query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsekit.llm import warc
from lapsekit.llm.registry import query, table

OP10_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS hex,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS best FROM pages
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '')
    AS payload_digest,
  CASE WHEN best IS NULL OR page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best OR page_id IS NULL THEN best END AS refers_to
FROM p
"""


@query("op10_warc", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).drop("url", "payload")
