"""Local outlier factor (Breunig et al., SIGMOD 2000), plain and per cluster."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.decisions import NORMAL, label_from_decision
from spendwatch.functions.sqltext import ident
from spendwatch.operators.neighbors import BLOCK_ROWS, CELL_ROWS, MAX_GROUPS, distances, distinct_points, nearest
from spendwatch.operators.quantiles import exact_quantiles
from spendwatch.operators.skew import held, spread_join
from spendwatch.session import cut_lineage, release, shuffles_freed

# Parameters of the two detectors, and the density guard.
LOF_NEIGHBORS = 25
CLUSTERED_NEIGHBORS = 20
CLUSTERS = 50
CONTAMINATION = 0.1
DENSITY_GUARD = 1e-10


@dataclass(frozen=True)
class LofModel:
    """Reference points with their densities, and the offset of each group."""

    points: DataFrame
    offsets: DataFrame
    k: int


def to_points(df: DataFrame, key: str, features: Sequence[str], group: Column | None = None) -> DataFrame:
    """Rows as ``(id, grp, x)``; without a group all rows are neighbours of each other.

    Features that are all 32-bit stay so, at half the size; distances are in 64 bits either way.
    """
    types = dict(df.dtypes)
    kind = "float" if all(types.get(f) == "float" for f in features) else "double"
    x = "array(" + ", ".join(f"cast({ident(f)} as {kind})" for f in features) + ")"
    return df.select(F.col(key).alias("id"), (F.lit(0) if group is None else group).cast("bigint").alias("grp"), F.expr(x).alias("x"))


def fit_lof(
    points: DataFrame, k: int = LOF_NEIGHBORS, contamination: float = CONTAMINATION,
    block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS,
) -> LofModel:
    """Densities and factors of all points among themselves.

    Per group a point has ``k`` neighbours, or all others when there are fewer.
    """
    with shuffles_freed(points.sparkSession):
        refs = cut_lineage(distinct_points(points))
        queries = refs.select(F.col("rid").alias("qid"), "grp", "x")
        lists = nearest(queries, refs, k, True, block_rows, cell_rows)
        reach = lists.filter(F.size("near") > 0).select(
            F.col("qid").alias("rid"), F.element_at("near", -1)["d"].alias("k_distance")
        )
        density = cut_lineage(_density(lists, reach).withColumnRenamed("qid", "rid").join(reach, "rid"))
        factors = cut_lineage(_factor(lists, density).withColumnRenamed("qid", "rid"))
        release(lists)
        fitted = cut_lineage(refs.join(density, "rid").join(factors, "rid"))
        release(refs, density, factors)
    # Every copy of a point counts in the quantile, as a weight.
    scores = fitted.select("grp", (-F.col("factor")).alias("score"), "w")
    cuts = exact_quantiles(scores, ["score"], [contamination], ["grp"], weight="w")
    offsets = cuts.select("grp", F.col("quantile").alias("offset"))
    return LofModel(fitted, offsets, k)


def _density(lists: DataFrame, reach: DataFrame) -> DataFrame:
    """Local reachability density from neighbour lists and the neighbours' k-distances."""
    pairs = lists.select("qid", F.explode("near").alias("n")).select("qid", "n.d", "n.rid", "n.w")
    seen = F.greatest("k_distance", "d")
    mean = F.sum(F.col("w") * seen) / F.sum("w")
    return spread_join(pairs, reach.select("rid", "k_distance"), ["rid"]).groupBy("qid").agg((1 / (mean + DENSITY_GUARD)).alias("density"))


def _factor(lists: DataFrame, density: DataFrame) -> DataFrame:
    """Mean density of the neighbours over a point's own density."""
    pairs = lists.select("qid", F.explode("near").alias("n")).select("qid", "n.rid", "n.w")
    theirs = spread_join(pairs, density.select("rid", "density"), ["rid"])
    mean = theirs.groupBy("qid").agg((F.sum(F.col("w") * F.col("density")) / F.sum("w")).alias("mean_density"))
    own = density.select(F.col("rid").alias("qid"), "density")
    return mean.join(own, "qid").select("qid", (F.col("mean_density") / F.col("density")).alias("factor"))


def fitted_labels(points: DataFrame, model: LofModel) -> DataFrame:
    """``(id, grp, factor, prediction)`` of the rows the model was fitted on."""
    scored = model.points.select("grp", "x", "factor").join(held(model.offsets, MAX_GROUPS, "groups"), "grp")
    label = label_from_decision(-F.col("factor") - F.col("offset"))
    labelled = scored.select("grp", "x", "factor", label.alias("prediction"))
    return spread_join(points, labelled, ["grp", "x"]).select("id", "grp", "factor", "prediction")


def score_lof(
    points: DataFrame, model: LofModel, block_rows: int = BLOCK_ROWS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``(id, grp, score, decision, prediction)`` of new rows against the reference points.

    Rows of a group without a model are normal.
    """
    with shuffles_freed(points.sparkSession):
        distinct = cut_lineage(distinct_points(points))
        queries = distinct.select(F.col("rid").alias("qid"), "grp", "x")
        refs = model.points.select("rid", "grp", "x", "w")
        lists = nearest(queries, refs, model.k, False, block_rows, cell_rows)
        known = model.points.select("rid", "k_distance", "density")
        own = cut_lineage(_density(lists, known.select("rid", "k_distance")))
        both = known.select("rid", "density")
        pairs = lists.select("qid", F.explode("near").alias("n")).select("qid", "n.rid", "n.w")
        mean = spread_join(pairs, both, ["rid"]).groupBy("qid").agg(
            (F.sum(F.col("w") * F.col("density")) / F.sum("w")).alias("mean_density")
        )
        factor = cut_lineage(mean.join(own, "qid").select("qid", (-F.col("mean_density") / F.col("density")).alias("score")))
        release(lists, own)
        scored = (
            distinct.join(factor, distinct["rid"] == factor["qid"], "left")
            .join(held(model.offsets, MAX_GROUPS, "groups"), "grp", "left")
            .select("grp", "x", "score", (F.col("score") - F.col("offset")).alias("decision"))
        )
        label = F.coalesce(label_from_decision(F.col("decision")), F.lit(NORMAL))
        labelled = cut_lineage(scored.select("grp", "x", "score", "decision", label.alias("prediction")))
        release(distinct, factor)
        labels = cut_lineage(spread_join(points, labelled, ["grp", "x"]).select("id", "grp", "score", "decision", "prediction"))
        release(labelled)
    return labels


def nearest_centroid(df: DataFrame, features: Sequence[str], centroids: dict[int, Sequence[float]]) -> Column:
    """Number of the closest centroid; the centroids are one vector per cluster."""
    numbers = np.array(sorted(centroids))
    shared = df.sparkSession.sparkContext.broadcast((numbers, np.array([centroids[i] for i in numbers], dtype=float)))

    @F.pandas_udf("bigint")
    def closest(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        names, centers = shared.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(names[distances(x, centers).argmin(axis=1)])

    return closest(*[F.col(ident(f)) for f in features])


def fit_clusters(df: DataFrame, features: Sequence[str], k: int = CLUSTERS, seed: int = 42) -> dict[int, list[float]]:
    """k-means centroids of the rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    assembled = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="skip").transform(df)
    model = KMeans(k=k, seed=seed, featuresCol="_x").fit(assembled.select("_x"))
    return {i: list(map(float, c)) for i, c in enumerate(model.clusterCenters())}
