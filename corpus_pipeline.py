"""Preparation of a training corpus in five stages over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes what a stage returns as Parquet in the shared folder and rereads it as
the next stage's documents. All stages but the last keep the columns of
``documents`` (and any others that the table has). Rows hold whole texts, so the
stages lower the session's Arrow batches to a bounded number of rows.

Nulls: a null text is an empty text in every stage, is scored like one, has no
near copies, passages or secrets, and packs to the end token alone. An empty
table passes through all stages. Repeated ids and rows are rows of their own,
except that near-duplicate removal keeps one row of each group.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spendwatch.llm.contamination import decontaminated
from spendwatch.llm.factorise import accepted
from spendwatch.llm.nearcopies import one_of_each
from spendwatch.llm.ownership import redacted
from spendwatch.llm.packing import pack
from spendwatch.llm.scratch import small_batches, written
from spendwatch.session import release_scratch, scratch_mark

#: Near copies: five-word shingles, 80 percent similarity.
SHINGLE_WORDS = 5
SIMILARITY = 80
#: Packing: sequence length and the id after each document.
CONTEXT = 4_096
END_ID = 2


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    small_batches(spark)
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    small_batches(spark)
    return one_of_each(docs, SHINGLE_WORDS, SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    small_batches(spark)
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live secrets in their texts replaced by a mark."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: where each lies in which sequence."""
    small_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), CONTEXT, END_ID)


STAGES = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL cannot express a trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = scratch_mark()
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        release_scratch(spark, mark, keep_last=True)  # what the stage read and made on the way
    return STAGES[-1][1](spark, docs, sf_dir)
