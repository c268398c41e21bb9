"""The corpus pipeline as a query."""

from __future__ import annotations

import corpus_pipeline
from lapsekit.llm.registry import query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
