"""The registered queries: each operator on the given tables, with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

MODULES = [
    "sources", "casting", "tables", "joining", "aggregating", "deriving", "labelling",
    "checking", "preparing", "modelling", "chains", "facts",
]


def load_all() -> None:
    """Import every module of queries, which registers them."""
    for name in MODULES:
        import_module(f"workloads.{name}")
