"""From detector scores to labels and confidences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label codes and their texts.
ANOMALY = -1
NORMAL = 1
ANOMALY_TEXT = "ANOMALIA"
NORMAL_TEXT = "NORMAL"
DEFAULT_CONFIDENCE = 0.5
RANGE_GUARD = 1e-9


def label_from_decision(decision: Column) -> Column:
    """Decision 0 or above is normal; an unknown decision has no label."""
    return label_from_threshold(decision, F.lit(0.0))


def label_from_threshold(score: Column, threshold: Column) -> Column:
    return F.when(score >= threshold, F.lit(NORMAL)).when(score < threshold, F.lit(ANOMALY))


def label_text(label: Column) -> Column:
    return F.when(label == ANOMALY, F.lit(ANOMALY_TEXT)).when(label.isNotNull(), F.lit(NORMAL_TEXT))


def logistic_confidence(decision: Column) -> Column:
    """0.5 on the boundary, towards 1 far from it; 0.5 without a decision."""
    value = 1.0 / (1.0 + F.exp(-F.abs(decision)))
    return F.coalesce(value, F.lit(DEFAULT_CONFIDENCE))


def range_confidence(score: Column, low: Column, high: Column) -> Column:
    """Position of a score within the range of all scores (higher = more normal)."""
    return (score - low) / (high - low + F.lit(RANGE_GUARD))
