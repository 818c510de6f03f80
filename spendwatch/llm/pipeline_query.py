"""The corpus pipeline as a query."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from spendwatch.llm.catalog import query


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
