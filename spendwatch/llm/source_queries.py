"""Divergence of sources over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendwatch.llm.catalog import query, table
from spendwatch.llm.sourceaudit import divergence_sql, source_divergence


@query("op13_source_divergence", divergence_sql())
def source_divergence_query(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))
