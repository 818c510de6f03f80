"""Detector quality: anomaly summary, cluster separation, silhouettes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.decisions import ANOMALY
from spendwatch.functions.sqltext import ident, number
from spendwatch.operators.sampling import sample_exact
from spendwatch.operators.skew import held
from spendwatch.session import cut_lineage

# Rows that the others are measured against at a time, and decimals of the metrics.
SILHOUETTE_BLOCK = 65_536
# Rows and points of one matrix product, which fits a core's cache; pairs measured again at once, and the share of the norms below which they are.
SILHOUETTE_ROWS, SILHOUETTE_STRIP, SILHOUETTE_PAIRS = 256, 1_024, 16_384
CANCELLED = 1e-6
RATE_DECIMALS = 5
METRIC_DECIMALS = 4
MAX_CLUSTERS = 10_000
MAX_SILHOUETTE_CLUSTERS = 64


def anomaly_summary(df: DataFrame, label: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    total = F.count(label)
    found = F.count_if(F.col(label) == ANOMALY)
    return df.groupBy(*by).agg(
        total.alias("total_samples"),
        found.alias("anomalies_detected"),
        (total - found).alias("normal_samples"),
        F.round(found / total, RATE_DECIMALS).alias("anomaly_rate"),
        F.count_distinct(label).alias("distinct_labels"),
    )


def _moments(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    """Per cluster: size, summed squared norm and feature sums, one pass."""
    value = [f"cast({ident(f)} as double)" for f in features]
    norm = " + ".join(f"{v} * {v}" for v in value)
    sums = ", ".join(f"sum({v})" for v in value)
    return df.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count("*").alias("n"), F.expr(f"sum({norm})").alias("sq"), F.expr(f"array({sums})").alias("sums")
    )


def _bounded(groups: DataFrame, limit: int) -> list:
    """One row per cluster on the driver, after checking how many there are."""
    rows = groups.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} clusters")
    return rows


def _residuals(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    """Per cluster: size, centroid, and squared and mean plain distance to it.

    Distances are taken from the centroid rather than from expanded squares,
    which would cancel badly for tight clusters far from the origin.
    """
    means = _moments(df, features, cluster).selectExpr("cluster AS _cluster", "transform(sums, s -> s / n) AS _center")
    centers = held(means, MAX_CLUSTERS, "clusters")
    squared = " + ".join(f"pow(cast({ident(f)} as double) - _center[{i}], 2)" for i, f in enumerate(features))
    joined = df.join(centers, F.col(cluster) == F.col("_cluster")).withColumn("_d2", F.expr(squared))
    return joined.groupBy(F.col("_cluster").alias("cluster")).agg(
        F.count("*").alias("n"),
        F.any_value("_center").alias("center"),
        F.sum("_d2").alias("ss"),
        F.avg(F.sqrt("_d2")).alias("spread"),
    )


def calinski_harabasz(df: DataFrame, features: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """Between-cluster over within-cluster dispersion, per degree of freedom.

    The rows are reduced to one record per cluster by Spark; what remains is
    arithmetic on those few records.
    """
    rows = _bounded(_residuals(df, features, cluster), MAX_CLUSTERS)
    k, n = len(rows), sum(r["n"] for r in rows)
    score = None
    if k > 1:
        size = np.array([r["n"] for r in rows], dtype=float)
        centers = np.array([r["center"] for r in rows], dtype=float)
        overall = (size[:, None] * centers).sum(axis=0) / n
        between = float((size * ((centers - overall) ** 2).sum(axis=1)).sum())
        within = float(sum(r["ss"] for r in rows))
        score = 1.0 if within == 0 else round(between * (n - k) / (within * (k - 1)), METRIC_DECIMALS)
    return df.sparkSession.createDataFrame([(k, n, score)], "clusters bigint, n_rows bigint, score double")


def davies_bouldin(df: DataFrame, features: Sequence[str], cluster: str = "prediction") -> DataFrame:
    """Mean over clusters of the worst spread-to-separation ratio.

    As above: the comparison of the few centroids is a k-by-k matrix.
    """
    rows = _bounded(_residuals(df, features, cluster), MAX_CLUSTERS)
    k = len(rows)
    centers = np.array([r["center"] for r in rows], dtype=float).reshape(k, -1)
    spread = np.array([r["spread"] for r in rows], dtype=float)
    worst = []
    for i in range(k):
        apart = np.sqrt(((centers - centers[i]) ** 2).sum(axis=1))
        ratio = np.divide(spread + spread[i], apart, out=np.zeros(k), where=apart > 0)
        worst.append(ratio.max(initial=0.0))
    score = round(float(np.mean(worst)), METRIC_DECIMALS) if k > 1 else None
    out = [(k, sum(r["n"] for r in rows), score)]
    return df.sparkSession.createDataFrame(out, "clusters bigint, n_rows bigint, score double")


def silhouette_rows(
    df: DataFrame,
    features: Sequence[str],
    cluster: str,
    key: str,
    rows: int | None = None,
    seed: object = 42,
) -> DataFrame:
    """Euclidean silhouette of each row, or of each row of an exact sample of ``rows`` rows.

    All rows are measured against all rows: blocks of about ``SILHOUETTE_BLOCK``
    rows are broadcast one after the other, each task measures its rows against
    the block by matrix products, without emitting pairs, and the sums per row and
    cluster are added up over the blocks. The work grows with the square of the rows,
    what a task or the driver holds does not.
    """
    spark = df.sparkSession
    chosen = df if rows is None else sample_exact(df, key, n=rows, seed=seed)
    dealt = chosen.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(cluster).cast("string"), F.lit("None")).alias("cluster"),
        F.expr("array(" + ", ".join(f"cast({ident(f)} as double)" for f in features) + ")").alias("x"),
    ).repartition(spark.sparkContext.defaultParallelism)
    points = cut_lineage(dealt.withColumn("id", F.monotonically_increasing_id()))
    sizes = {r["cluster"]: r["n"] for r in _bounded(points.groupBy("cluster").agg(F.count("*").alias("n")), MAX_CLUSTERS)}
    blocks = max(1, -(-sum(sizes.values()) // SILHOUETTE_BLOCK))
    schema = f"id bigint, key {points.schema['key'].dataType.simpleString()}, cluster string, other string, total double"

    sums = None
    for block in range(blocks):
        held_rows = points.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).select("cluster", "x").toPandas()
        names, codes = np.unique(held_rows["cluster"].to_numpy(dtype=str), return_inverse=True)
        shared = spark.sparkContext.broadcast((np.array(held_rows["x"].tolist(), dtype=float).reshape(len(held_rows), len(features)), codes, list(names)))

        def measure(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            pts, codes, names = shared.value
            order = np.argsort(codes, kind="stable")
            pts, starts = pts[order], np.searchsorted(codes[order], np.arange(len(names)))
            for batch in batches:
                for start in range(0, len(batch) if names else 0, SILHOUETTE_ROWS):
                    part = batch.iloc[start : start + SILHOUETTE_ROWS]
                    total = cluster_totals(np.array(part["x"].tolist(), dtype=float), pts, starts)
                    again = part.loc[part.index.repeat(len(names)), ["id", "key", "cluster"]]
                    yield again.assign(other=names * len(part), total=total.ravel())

        part_sums = points.select("id", "key", "cluster", "x").mapInPandas(measure, schema)
        if blocks > 1:
            part_sums = cut_lineage(part_sums)
            shared.unpersist()
        sums = part_sums if sums is None else sums.unionByName(part_sums)

    table = spark.createDataFrame(list(sizes.items()), "other string, n bigint")
    summed = sums.groupBy("id", "other").agg(F.any_value("key").alias("key"), F.any_value("cluster").alias("cluster"), F.sum("total").alias("total"))
    own = F.col("cluster") == F.col("other")
    each = summed.join(F.broadcast(table), "other").groupBy("id").agg(
        F.any_value("key").alias("key"),
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("inner"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("nearest"),
    )
    top = F.greatest("inner", "nearest")
    value = F.when(F.col("inner").isNotNull() & F.col("nearest").isNotNull() & (top > 0), (F.col("nearest") - F.col("inner")) / top)
    return each.select("key", F.coalesce(value, F.lit(0.0)).alias("silhouette"))


def cluster_totals(x: np.ndarray, pts: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Summed distances of each row of ``x`` to each run of ``pts``, the runs beginning at ``starts``.

    Squares come from a matrix product per strip of ``pts``, taken from the
    strip's middle; those so small that they cancel are measured again.
    """
    total, edges = np.zeros((len(x), len(starts))), [*starts.tolist(), len(pts)]
    for c in range(len(starts)):
        for at in range(edges[c], edges[c + 1], SILHOUETTE_STRIP):
            y = pts[at : min(at + SILHOUETTE_STRIP, edges[c + 1])]
            with np.errstate(all="ignore"):
                middle = y.mean(axis=0)
                a, b = x - middle, y - middle
                norms, others = (a * a).sum(axis=1), (b * b).sum(axis=1)
                left = np.concatenate((-2 * a, norms[:, None], np.ones((len(a), 1))), axis=1)
                square = left @ np.concatenate((b.T, np.ones((1, len(b))), others[None, :]))
                i, j = np.nonzero(~(square > CANCELLED * (norms + others.max())[:, None]))
                for k in range(0, len(i), SILHOUETTE_PAIRS):
                    part = slice(k, k + SILHOUETTE_PAIRS)
                    square[i[part], j[part]] = ((x[i[part]] - y[j[part]]) ** 2).sum(axis=1)
                total[:, c] += np.sqrt(square, out=square).sum(axis=1)
    return total


def silhouette_euclidean(
    df: DataFrame, features: Sequence[str], cluster: str, key: str, rows: int | None = None, seed: object = 42
) -> DataFrame:
    each = silhouette_rows(df, features, cluster, key, rows, seed)
    return each.agg(F.count("*").alias("n_rows"), F.round(F.avg("silhouette"), METRIC_DECIMALS).alias("score"))


def silhouette_squared(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    """Silhouette under squared distance over all rows, in linear time.

    The mean squared distance from a row to a cluster follows from the
    cluster's size, sums and squared norms, so no pair of rows is formed.
    """
    groups = _bounded(_moments(df.filter(F.col(cluster).isNotNull()), features, cluster), MAX_SILHOUETTE_CLUSTERS)
    # Shift to the global centroid first: expanded squares cancel less there.
    n_all = sum(g["n"] for g in groups)
    center = [sum(g["sums"][i] for g in groups) / max(n_all, 1) for i in range(len(features))]
    shifted = df.filter(F.col(cluster).isNotNull()).selectExpr(
        f"{ident(cluster)} AS cluster",
        *[f"cast({ident(f)} as double) - {number(c)} AS x{i}" for i, (f, c) in enumerate(zip(features, center, strict=True))],
    )
    names = [f"x{i}" for i in range(len(features))]
    moments = _bounded(_moments(shifted, names, "cluster"), MAX_SILHOUETTE_CLUSTERS)
    scored = shifted.withColumn("norm", F.expr(" + ".join(f"{x} * {x}" for x in names)))

    same, alone, others = F.lit(None).cast("double"), F.lit(False), []
    for m in moments:
        dot = " + ".join(f"{x} * {number(m['sums'][i] / m['n'])}" for i, x in enumerate(names))
        spread = F.expr(f"norm - 2 * ({dot}) + {number(m['sq'] / m['n'])}")
        here = F.col("cluster") == F.lit(m["cluster"])
        same = F.when(here, spread * m["n"] / max(m["n"] - 1, 1)).otherwise(same)
        alone = F.when(here, F.lit(m["n"] == 1)).otherwise(alone)
        others.append(F.when(~here, spread))
    nearest = F.least(*others) if len(others) > 1 else others[0]
    value = F.when(alone, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(nearest - same, F.greatest(nearest, same)), F.lit(0.0))
    )
    return scored.select(value.alias("s")).agg(
        F.count("*").alias("n_rows"), F.round(F.avg("s"), METRIC_DECIMALS).alias("score")
    )
