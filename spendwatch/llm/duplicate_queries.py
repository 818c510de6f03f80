"""Repeated passages and near copies over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendwatch.llm.catalog import query, table
from spendwatch.llm.checks import repeats_sql
from spendwatch.llm.nearcopies import near_copies
from spendwatch.llm.repeats import REPEAT, removed_words


@query("op2_substring_dedup", repeats_sql(REPEAT))
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removed_words(table(spark, folder, "documents"))


NEAR_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) m ON m.x = s.doc_id
"""


@query("op8_near_dedup", NEAR_SQL)
def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "documents"), 3, 85)
