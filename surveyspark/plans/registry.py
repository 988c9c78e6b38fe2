"""Query registry: ``name -> (spark builder, DuckDB oracle text)``.

Builders take ``(spark, sf_dir)`` and return a lazy DataFrame. Oracle texts
are run by DuckDB with the driver's tables registered as views; ``None``
means the operator is not expressible in SQL and gets a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import (queries_core, queries_eval, queries_folds, queries_import, queries_ingest,  # noqa: F401
                   queries_ops, queries_quality, queries_scoring)
