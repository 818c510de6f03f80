"""Named queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

_MODULES = ("count_queries", "text_queries", "duplicate_queries", "model_queries", "source_queries", "vector_queries", "pipeline_query")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL where SQL can express it."""

    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_catalog() -> tuple[dict[str, Query], dict[str, str]]:
    """All registered queries and their SQL."""
    for module in _MODULES:
        import_module(f"spendwatch.llm.{module}")
    return dict(QUERIES), dict(ORACLE)
