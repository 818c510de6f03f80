"""Any number of trained detectors over one table, and their votes.

Detectors that judge a row alone share one pass. A local outlier model needs
neighbours and has a plan of its own. Each detector's labels are written
bucketed and sorted by the row key, so the votes of all of them meet by merge
joins of equal buckets: no label is shuffled again, however many detectors
vote.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.decisions import ANOMALY, NORMAL, label_from_decision
from spendwatch.operators.iforest import Forest, with_scores
from spendwatch.operators.lof import LofModel, score_lof, to_points
from spendwatch.operators.ocsvm import OneClassSvm, decision
from spendwatch.session import scratch_path, shuffles_freed
from spendwatch.sources.modelstore import Model, Threshold

BUCKETS = 16


def label_rows(df: DataFrame, key: str, model: Model, features: Sequence[str]) -> DataFrame:
    """``key, prediction`` of every row, by the scorer of the model's kind.

    Rows without a decision, which a local outlier model gives to groups it
    does not know, are normal.
    """
    if isinstance(model, Forest):
        return with_scores(df, model).select(key, label_from_decision(F.col("decision")).alias("prediction"))
    if isinstance(model, OneClassSvm):
        return df.withColumn("decision", decision(df, model)).select(key, label_from_decision(F.col("decision")).alias("prediction"))
    if isinstance(model, Threshold):
        return df.select(key, label_from_decision(F.col(model.column) - F.lit(model.cut)).alias("prediction"))
    if isinstance(model, LofModel):
        return score_lof(to_points(df, key, features), model).select(F.col("id").alias(key), "prediction")
    raise TypeError(f"no scorer for {type(model).__name__}")


def label_tables(df: DataFrame, key: str, models: Mapping[str, tuple[Model, Sequence[str]]], buckets: int = BUCKETS) -> dict[str, str]:
    """One written table of labels per detector, bucketed and sorted by the key; its name by detector."""
    names = {}
    for name, (model, features) in models.items():
        table = f"labels_{uuid.uuid4().hex}"
        labels = label_rows(df, key, model, features).select(key, F.col("prediction").cast("int").alias("prediction"))
        # one file for each bucket, so that a bucket is already sorted
        with shuffles_freed(df.sparkSession):
            dealt = labels.repartition(buckets, key)
            dealt.write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(df.sparkSession, table)).saveAsTable(table)
        names[name] = table
    return names


def votes(spark, tables: Mapping[str, str], key: str) -> DataFrame:
    """``key`` and one column of labels per detector, by merge joins of equal buckets."""
    each = [spark.table(t).select(key, F.col("prediction").alias(n)).hint("merge") for n, t in tables.items()]
    return reduce(lambda a, b: a.join(b, key), each)


def decided(voted: DataFrame, key: str, names: Sequence[str], rules: Column, block_at: int) -> DataFrame:
    """Votes, majority label and action of each row from its label columns; no shuffle."""
    count = sum((F.col(n) == ANOMALY).cast("int") for n in names)
    action = F.when(F.col("votes") >= block_at, "block").when((F.col("votes") > 0) | F.col("rule_hit"), "alert").otherwise("allow")
    counted = voted.withColumn("votes", count).withColumn("rule_hit", F.coalesce(rules, F.lit(False)))
    majority = F.when(F.col("votes") * 2 > len(names), ANOMALY).otherwise(NORMAL)
    return counted.select(key, *names, "votes", "rule_hit", majority.alias("prediction"), action.alias("action"))


def compared(voted: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per detector: rows, flagged rows and their share, in one pass over the joined labels."""
    counts = voted.agg(F.count("*").alias("n"), *[F.count_if(F.col(n) == ANOMALY).alias(f"a{k}") for k, n in enumerate(names)])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model_name"), F.col("n").alias("total_samples"), F.col(f"a{k}").alias("anomalies_detected")) for k, n in enumerate(names)]))
    rows = counts.select(each.alias("r")).select("r.*")
    return rows.withColumn("normal_samples", F.col("total_samples") - F.col("anomalies_detected")).withColumn(
        "anomaly_rate", F.round(F.try_divide("anomalies_detected", "total_samples"), 5)
    )
