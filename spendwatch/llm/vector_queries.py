"""Whitening over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendwatch.llm.catalog import query, table
from spendwatch.llm.whitening import whitened


@query("op11_embedding_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened(table(spark, folder, "embeddings"))
