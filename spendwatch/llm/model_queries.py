"""Trained models over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.llm import personal
from spendwatch.llm.catalog import query, table
from spendwatch.llm.factorise import ACCEPT, held_out, scored, train


@query("op9_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machine = train(docs, table(spark, folder, "labels"))
    return scored(docs, machine, ["doc_id"]).select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )


@query("op6_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.find_personal(table(spark, folder, "documents"), personal.trained())
