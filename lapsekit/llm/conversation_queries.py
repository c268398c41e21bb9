"""The chat formatting query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsekit.llm import chat
from lapsekit.llm.registry import query, table

CONTROL_TEXT = "\\### Assistant: </turn> ok"

OP6_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '</turn>', ''))) / 7 + (length(text) - length(replace(text, '</role>', ''))) / 7
      + (length(text) - length(replace(text, '<|', ''))) / 2
      + coalesce(list_sum(list_transform(regexp_extract_all(text, '##+'), lambda s: length(s) - 1)), 0) AS body
  FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + length(role) + 8 + body + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op6_chat_formatting", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string"
    )
    return chat.digests(chat.formatted(turns.unionByName(more)))
