"""Compositions of operators over whole tables."""

from __future__ import annotations

from importlib import import_module

_MODULES = (
    "ingest_queries",
    "model_queries",
    "eval_queries",
    "stream_queries",
    "density_queries",
    "detector_queries",
    "analytics_queries",
    "backtest_queries",
)


def load_catalog() -> tuple[dict, dict]:
    """All registered queries and their SQL."""
    for module in _MODULES:
        import_module(f"spendwatch.plans.{module}")
    from spendwatch.plans.catalog import ORACLE, QUERIES

    return dict(QUERIES), dict(ORACLE)
