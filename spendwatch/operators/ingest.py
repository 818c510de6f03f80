"""Joining transactions to users and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.operators.skew import spread_join


def join_users(
    transactions: DataFrame,
    users: DataFrame,
    key: str = "client_id",
    user_key: str = "id",
    null_safe: bool = False,
) -> DataFrame:
    """Inner join of transactions with users; several user rows fan out.

    Names present on both sides get ``_transaction`` / ``_user`` and the
    redundant user key is dropped. ``null_safe`` also pairs NULL keys, as a
    data-frame merge would. Clients holding many rows are spread over tasks.
    """
    both = set(transactions.columns) & set(users.columns)
    left = transactions.select(
        *[F.col(c).alias(f"{c}_transaction") if c in both else F.col(c) for c in transactions.columns]
    )
    right = users.select(
        *[F.col(c).alias(f"{c}_user") if c in both else F.col(c) for c in users.columns]
    )
    left_name = f"{key}_transaction" if key in both else key
    right_name = f"{user_key}_user" if user_key in both else user_key
    keyed = right.withColumnRenamed(right_name, left_name)
    return spread_join(left, keyed, [left_name], "inner", null_safe)


def add_mcc_description(transactions: DataFrame, mcc: DataFrame) -> DataFrame:
    """Left join of the code lookup; unknown codes keep a NULL description."""
    return spread_join(transactions, mcc, ["mcc"], "left")


def label_coverage(ids: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct labelled ids, distinct transaction ids, and how many match.

    One aggregation over the tagged union of both id sets: each id is shuffled
    once, already reduced by the map-side combine.
    """
    tagged = labels.select("id", F.lit(1).alias("is_label")).unionByName(
        ids.select("id", F.lit(0).alias("is_label"))
    )
    per_id = tagged.groupBy("id").agg(
        F.max("is_label").alias("labelled"), F.max(1 - F.col("is_label")).alias("present")
    )
    return per_id.filter("id IS NOT NULL").agg(
        F.coalesce(F.sum("labelled"), F.lit(0)).cast("bigint").alias("label_ids"),
        F.coalesce(F.sum("present"), F.lit(0)).cast("bigint").alias("transaction_ids"),
        F.coalesce(F.sum(F.col("labelled") * F.col("present")), F.lit(0)).cast("bigint").alias("matching_ids"),
    )


def matching_transactions(transactions: DataFrame, labels: DataFrame) -> DataFrame:
    return transactions.join(labels.select("id"), "id", "left_semi")


def unmatched_labels(labels: DataFrame, transactions: DataFrame) -> DataFrame:
    """Labels whose transaction is absent."""
    return labels.join(transactions.select("id"), "id", "left_anti")
