"""Comparing and combining detectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.decisions import ANOMALY, NORMAL
from spendwatch.operators.quality import anomaly_summary

# Detector types that can be trained.
KNOWN_TYPES = ("isolation_forest", "lof", "one_class_svm")

# Cores assumed in per-core rates, and seconds in an hour.
CORES = 4
HOUR = 3600


def known_types(asked: Sequence[str]) -> list[str]:
    """The trainable detector types among those asked for; other names are ignored."""
    return [name for name in asked if name in KNOWN_TYPES]


def compare_models(scored: DataFrame, model: str = "model_name", label: str = "prediction") -> DataFrame:
    """One metric row per model from the union of their predictions."""
    return anomaly_summary(scored, label, by=[model]).drop("distinct_labels")


def performance(df: DataFrame, rows: Column, seconds: Column) -> DataFrame:
    """Throughput, per-core rate and hourly capacity; no time means no rate."""
    rate = F.when(seconds > 0, rows / seconds).otherwise(F.lit(0.0))
    return df.withColumns(
        {
            "inference_time_seconds": F.round(seconds, 4),
            "throughput": F.round(rate, 2),
            "samples_per_core_per_second": F.round(rate / CORES, 2),
            "hourly_capacity": F.round(F.round(rate, 2) * HOUR, 0),
        }
    )


def best_model(metrics: DataFrame, order: str, name: str = "model_name", by: str = "throughput") -> DataFrame:
    """The fastest model; among equals, the one listed first."""
    best = F.max_by(F.struct(name, by), F.struct(F.col(by), -F.col(order)))
    return metrics.agg(best.alias("b")).select(f"b.{name}", f"b.{by}")


def scoring_log_summary(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Predictions, successes, success share and mean latency from a scoring log.

    ``log`` has ``batch_size``, ``seconds`` and ``success`` per scoring call.
    """
    made, good = F.sum("batch_size"), F.sum(F.when(F.col("success"), F.col("batch_size")).otherwise(0))
    per = F.greatest(made, F.lit(1))
    return log.groupBy(*by).agg(
        made.alias("predictions_made"),
        good.alias("success_count"),
        F.round(good / per * 100, 1).alias("success_rate"),
        F.round(F.sum("seconds") / per * 1000, 2).alias("avg_inference_time_ms"),
        F.round(F.try_divide(made, F.sum("seconds")), 0).alias("throughput"),
    )


def ensemble(votes: DataFrame, key: str, rules: Column, block_at: int) -> DataFrame:
    """Block, alert or allow from detector votes and fixed rules.

    ``votes`` has one row per key and detector with its ``prediction``;
    ``rules`` is a row predicate that alone justifies an alert.
    """
    counted = votes.groupBy(key).agg(
        F.count_if(F.col("prediction") == ANOMALY).alias("votes"),
        F.count("prediction").alias("detectors"),
        F.coalesce(F.bool_or(rules), F.lit(False)).alias("rule_hit"),
    )
    action = (
        F.when(F.col("votes") >= block_at, "block")
        .when((F.col("votes") > 0) | F.col("rule_hit"), "alert")
        .otherwise("allow")
    )
    majority = F.when(F.col("votes") * 2 > F.col("detectors"), ANOMALY).otherwise(NORMAL)
    return counted.select(key, "votes", "rule_hit", majority.alias("prediction"), action.alias("action"))
