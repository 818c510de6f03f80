"""Model artifact names and detector kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suffixes cut from artifact names, in this order of preference.
NAME_SUFFIXES = ("_i3_optimized", "_optimized", "_model")
STAMP_PATTERN = r"_\d{8}_\d{6}$"


def model_name(filename: Column) -> Column:
    """Cut at the first dot, at the first known suffix, then drop a time stamp."""
    stem = F.substring_index(filename, ".", 1)
    cut = stem
    for suffix in reversed(NAME_SUFFIXES):
        cut = F.when(stem.contains(suffix), F.split(stem, suffix)[0]).otherwise(cut)
    return F.regexp_replace(cut, STAMP_PATTERN, "")


def artifact_name(model_type: Column, run_ts: Column) -> Column:
    """``{type}_{yyyyMMdd_HHmmss}``."""
    return F.concat(model_type, F.lit("_"), F.date_format(run_ts, "yyyyMMdd_HHmmss"))


def detector_kind(members: Column, methods: Column) -> Column:
    """How an artifact must be scored.

    ``members`` lists the parts of a composite artifact (NULL for a bare
    model) and ``methods`` the scoring methods of a bare model.
    """
    has = lambda column, value: F.array_contains(column, value)
    return (
        F.when(has(members, "clusterer") & has(members, "lof_models"), "hierarchical_lof")
        .when(has(members, "approximator") & has(members, "svm_model"), "hierarchical_svm")
        .when(members.isNotNull(), "dict_artifact")
        .when(has(methods, "predict"), "standard_predict")
        .when(has(methods, "decision_function"), "decision_function")
        .when(has(methods, "score_samples"), "score_samples")
        .when(has(methods, "fit_predict"), "fit_predict_only")
        .otherwise("unknown")
    )
