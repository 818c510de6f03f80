"""Descriptive statistics, histograms and density curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.sqltext import ident, text
from spendwatch.operators.quantiles import exact_quantiles, long_form
from spendwatch.operators.skew import held

# Quartiles of a description, bins of a histogram, points of a curve.
QUARTILES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = 100
CURVE_POINTS = 200
CURVE_CUT = 3.0
MAX_LABELS = 1_000


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null values with their frequency, most frequent first."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), column)


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    keys = [*by, "column_name"]
    moments = (
        long_form(df, columns, by)
        .groupBy(*keys)
        .agg(
            F.count("value").alias("n"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    pivoted = (
        exact_quantiles(df, columns, QUARTILES, by)
        .groupBy(*keys)
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(f"p{int(p * 100)}")
                for p in QUARTILES
            ]
        )
    )
    joined = moments.join(pivoted, keys) if not by else _null_safe_join(moments, pivoted, keys)
    return joined.select(*keys, "n", "mean", "std", "min", "p25", "p50", "p75", "max")


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, condition).drop(*[f"_r_{k}" for k in keys])


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, non-null and null counts, from one pass."""
    counts = df.selectExpr("count(*) AS n", *[f"count({ident(c)}) AS c{i}" for i, c in enumerate(df.columns)])
    items = ", ".join(f"{text(c)}, {text(kind)}, n, c{i}, n - c{i}" for i, (c, kind) in enumerate(df.dtypes))
    return counts.selectExpr(
        f"stack({len(df.columns)}, {items}) AS (column_name, data_type, n_rows, n_present, n_missing)"
    )


def density_histogram(df: DataFrame, column: str, label: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between each label's extremes; areas sum to one.

    Only occupied bins are listed.
    """
    known = df.select(F.col(label).alias("label"), F.col(column).cast("double").alias("value")).filter(
        "value IS NOT NULL AND label IS NOT NULL"
    )
    extremes = known.groupBy("label").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")
    )
    edges = held(extremes, MAX_LABELS, "labels")
    width = (F.col("hi") - F.col("lo")) / bins
    placed = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("value") - F.col("lo")) / width)).otherwise(0)
    bin_ = F.least(placed, F.lit(bins - 1)).cast("int")
    return (
        known.join(edges, "label")  # the few labels' edges are broadcast: rows meet only as bins
        .groupBy("label", bin_.alias("bin"), "lo", "hi", "n")
        .agg(F.count("*").alias("rows_in_bin"))
        .select(
            "label",
            "bin",
            (F.col("lo") + F.col("bin") * width).alias("bin_start"),
            "rows_in_bin",
            F.try_divide(F.col("rows_in_bin"), F.col("n") * width).alias("density"),
        )
    )


# A Gaussian kernel is exactly 0 in double precision beyond this many widths.
KERNEL_REACH = 38.7


def density_curve(
    df: DataFrame, column: str, label: str, points: int = CURVE_POINTS, cut: float = CURVE_CUT
) -> DataFrame:
    """Gaussian kernel density per label on an even grid.

    The bandwidth follows Scott's rule (n^(-1/5) sample deviations) and the
    grid reaches ``cut`` bandwidths beyond the data. Each row contributes only
    to the grid points where its kernel is not exactly zero; contributions are
    summed map-side, so the shuffle carries at most ``points`` rows per label
    and task.
    """
    known = df.select(F.col(label).alias("label"), F.col(column).cast("double").alias("value")).filter(
        "value IS NOT NULL AND label IS NOT NULL"
    )
    stats = known.groupBy("label").agg(
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.count("*").alias("n"),
        F.stddev_samp("value").alias("sd"),
    )
    width = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    grid = (
        held(stats.filter("sd > 0"), MAX_LABELS, "labels")
        .withColumn("h", width)
        .withColumn("start", F.col("lo") - cut * F.col("h"))
        .withColumn("step", (F.col("hi") + cut * F.col("h") - F.col("start")) / (points - 1))
        .select("label", "n", "h", "start", "step")
    )
    weighted = known.join(F.broadcast(grid), "label")
    reach = F.lit(KERNEL_REACH) * F.col("h")
    first = F.greatest(F.ceil((F.col("value") - reach - F.col("start")) / F.col("step")), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("value") + reach - F.col("start")) / F.col("step")), F.lit(points - 1)).cast("int")
    spread = weighted.withColumn("point", F.explode(F.sequence(first, last)))
    z = (F.col("start") + F.col("point") * F.col("step") - F.col("value")) / F.col("h")
    kernel = F.exp(-0.5 * z * z)
    summed = spread.groupBy("label", "point").agg(F.sum(kernel).alias("mass"))
    skeleton = grid.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    norm = F.col("n") * F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5)
    return (
        skeleton.join(summed, ["label", "point"], "left")
        .select(
            "label",
            "point",
            (F.col("start") + F.col("point") * F.col("step")).alias("x"),
            (F.coalesce(F.col("mass"), F.lit(0.0)) / norm).alias("density"),
        )
    )
