"""The logical entities, mapped onto the available tables.

Transactions are ``events`` (amount and date turned into raw text first, so the
cleaning step has real work), users are ``customer``, fraud labels are the
``error`` events. The ``SQL_*`` fragments are the same mappings for checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.functions.cleaning import format_money
from spendwatch.operators.features import join_and_build
from spendwatch.operators.ingest import join_users


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mcc_code(props: Column) -> Column:
    return F.from_json(props, "k int")["k"]


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("client_id"),
        F.col("ts").cast("string").alias("date"),
        format_money(F.col("value")).alias("amount"),
        F.col("event_type").alias("use_chip"),
        mcc_code(F.col("props")).alias("mcc"),
    )


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"),
        format_money(F.col("c_acctbal")).alias("yearly_income"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_nationkey").alias("nation_id"),
    )


def primary(spark: SparkSession, folder: str) -> DataFrame:
    return join_users(raw_transactions(spark, folder), raw_users(spark, folder))


def featured(spark: SparkSession, folder: str) -> DataFrame:
    return join_and_build(raw_transactions(spark, folder), raw_users(spark, folder))


SQL_PRIMARY = """
primary_rows AS (
  SELECT e.event_id AS id_transaction, e.user_id AS client_id, e.ts AS date,
         e.value AS amount, e.event_type AS use_chip,
         CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS mcc,
         c.c_acctbal AS yearly_income, c.c_mktsegment AS gender, c.c_nationkey AS nation_id
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""

SQL_FEATURED = (
    SQL_PRIMARY
    + """,
featured AS (
  SELECT *, transaction_hour <= 6 OR transaction_hour >= 22 AS is_night_transaction,
         day_of_week IN (5, 6) AS is_weekend
  FROM (SELECT *, CAST(hour(date) AS INTEGER) AS transaction_hour,
               CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
               CAST(month(date) AS INTEGER) AS month,
               amount / nullif(avg(amount) OVER (PARTITION BY client_id) + 1, 0) AS amount_vs_avg
        FROM primary_rows))"""
)


def sql_draw(seed: object, *parts: str) -> str:
    """The row-key draw of :func:`spendwatch.functions.hashing.unit_hash` in SQL."""
    key = "concat_ws(':', '" + str(seed) + "', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"(CAST(('0x' || substr(md5({key}), 1, 13)) AS BIGINT) / 4503599627370496.0)"
