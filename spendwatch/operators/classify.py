"""Supervised metrics, group comparison and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.operators.quantiles import exact_quantiles, running_totals

# Service targets.
RECALL_MIN = 0.90
PRECISION_MIN = 0.85
FALSE_POSITIVE_RATE_MAX = 0.02
DRIFT_BINS = 10
DRIFT_FLOOR = 1e-6


def confusion_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts and rates from boolean ``actual`` and ``predicted``, in one pass."""
    a, p = F.col(actual), F.col(predicted)
    counts = df.agg(
        F.count_if(a & p).alias("true_positive"),
        F.count_if(~a & p).alias("false_positive"),
        F.count_if(a & ~p).alias("false_negative"),
        F.count_if(~a & ~p).alias("true_negative"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    rate = F.try_divide(fp, fp + tn)
    return counts.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
            "false_positive_rate": rate,
            "meets_targets": F.coalesce(
                (recall >= RECALL_MIN) & (precision >= PRECISION_MIN) & (rate <= FALSE_POSITIVE_RATE_MAX), F.lit(False)
            ),
        }
    )


def auc(df: DataFrame, actual: str, score: str, buckets: int = 256) -> DataFrame:
    """Area under the ROC curve; equal scores count one half.

    Rows are merged to one record per distinct score, then every positive
    counts the negatives below it through running totals, so no task sorts the
    whole table and tied scores cost nothing.
    """
    per_score = df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(actual)).alias("pos"), F.count_if(~F.col(actual)).alias("neg")
    )
    ranked = running_totals(per_score.filter("score IS NOT NULL"), "score", ["neg"], buckets)
    wins = F.sum(F.col("pos") * (F.col("neg_before").cast("double") + 0.5 * F.col("neg")))
    return ranked.agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), wins.alias("wins")
    ).select(
        "positives", "negatives", F.try_divide(F.col("wins"), F.col("positives").cast("double") * F.col("negatives")).alias("auc")
    )


def compare_groups(df: DataFrame, group: str, value: str, control: object, treatment: object) -> DataFrame:
    """Welch statistic of treatment against control from one grouped aggregate."""

    def moments(name: object, tag: str) -> list:
        mine = F.when(F.col(group) == F.lit(name), F.col(value))
        return [
            F.count(mine).alias(f"n_{tag}"), F.avg(mine).alias(f"mean_{tag}"), F.var_samp(mine).alias(f"var_{tag}")
        ]

    both = df.filter(F.col(group).isin(control, treatment)).agg(*moments(control, "control"), *moments(treatment, "treatment"))
    a, b = F.col("var_control") / F.col("n_control"), F.col("var_treatment") / F.col("n_treatment")
    freedom = F.try_divide(
        F.pow(a + b, 2),
        F.pow(a, 2) / (F.col("n_control") - 1) + F.pow(b, 2) / (F.col("n_treatment") - 1),
    )
    return both.select(
        "n_control",
        "n_treatment",
        "mean_control",
        "mean_treatment",
        (F.col("mean_treatment") - F.col("mean_control")).alias("difference"),
        F.try_divide(F.col("mean_treatment") - F.col("mean_control"), F.sqrt(a + b)).alias("t_statistic"),
        freedom.alias("degrees_of_freedom"),
    )


def population_stability(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = DRIFT_BINS
) -> DataFrame:
    """Stability index per column over the baseline's quantile bins.

    The edges are a handful of numbers per column; both tables are then reduced
    to bin counts in one pass each.
    """
    probs = [i / bins for i in range(1, bins)]
    edges: dict[str, list[float]] = {c: [] for c in columns}
    for row in exact_quantiles(baseline, columns, probs).collect():
        edges[row["column_name"]].append(row["quantile"])

    def counts(df: DataFrame, tag: str) -> DataFrame:
        parts = None
        for name in columns:
            place = sum((F.col(name) > e).cast("int") for e in sorted(edges[name]))
            column = F.struct(F.lit(name).alias("column_name"), place.alias("bin"))
            parts = [column] if parts is None else [*parts, column]
        placed = df.select(F.explode(F.array(*parts)).alias("p")).select("p.column_name", "p.bin").filter("bin IS NOT NULL")
        return placed.groupBy("column_name", "bin").agg(F.count("*").alias(tag))

    grid = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(b).alias("bin")) for c in columns for b in range(bins)])
    ).alias("g")
    skeleton = baseline.sparkSession.range(1).select(grid).select("g.*")
    both = (
        skeleton.join(counts(baseline, "n0"), ["column_name", "bin"], "left")
        .join(counts(current, "n1"), ["column_name", "bin"], "left")
        .na.fill(0, ["n0", "n1"])
    )
    totals = both.groupBy("column_name").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    share = both.join(totals, "column_name").select(
        "column_name",
        F.greatest(F.col("n0") / F.col("t0"), F.lit(DRIFT_FLOOR)).alias("p"),
        F.greatest(F.col("n1") / F.col("t1"), F.lit(DRIFT_FLOOR)).alias("q"),
    )
    index = F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p")))
    return share.groupBy("column_name").agg(index.alias("psi"))


