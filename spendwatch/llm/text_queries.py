"""Extraction, contamination and secrets over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.llm import checks
from spendwatch.llm.catalog import query, table
from spendwatch.llm.contamination import WINDOW, scan
from spendwatch.llm.divergence import quality
from spendwatch.llm.extraction import extract
from spendwatch.llm.ownership import counted_holders, scan_secrets


@query("op3_decontamination", checks.contamination_sql(WINDOW))
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op4_quality_rules", checks.quality_sql())
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("character_distance", 6).alias("character_distance"), F.round("common_distance", 6).alias("common_distance"),
    )


@query("op10_secrets", checks.secrets_sql())
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_shared", counted_holders("held").alias("holders"))


@query("op1_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
