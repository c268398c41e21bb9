"""The queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from importlib import import_module

from lapsekit.llm.registry import ORACLES, QUERIES

MODULES = [
    "conversation_queries", "dedup_queries", "mining_queries", "page_queries",
    "rewriting_queries", "scoring_queries", "pipeline_queries",
]

for _name in MODULES:
    import_module(f"lapsekit.llm.{_name}")

__all__ = ["ORACLES", "QUERIES"]
