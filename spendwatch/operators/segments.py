"""Client segments, supervised models and offers on MLlib."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ITEMS = 100_000
#: Items whose scores are held at once.
ITEM_BLOCK = 4_096


def kmeans_segments(df: DataFrame, features: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Rows with the ``segment`` of a k-means on standardized features.

    ``own_distance`` and ``least_distance`` are the squared distances to the
    segment's centre and to the nearest centre.
    """
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_x", withMean=True),
        KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="segment"),
    ]
    model = Pipeline(stages=stages).fit(df)
    centres = [c.tolist() for c in model.stages[-1].clusterCenters()]
    made = model.transform(df).withColumn("_at", vector_to_array("_x"))
    far = [F.aggregate(F.zip_with("_at", F.array(*map(F.lit, c)), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d) for c in centres]
    return made.withColumn("_far", F.array(*far)).select(
        *df.columns, "segment", F.get("_far", F.col("segment")).alias("own_distance"), F.array_min("_far").alias("least_distance")
    )


def classify(df: DataFrame, features: Sequence[str], label: str, method: str, seed: int = 42, **params) -> DataFrame:
    """Fit on rows with ``is_test`` false; score all rows as ``probability`` and ``predicted``."""
    kinds = {"random_forest": RandomForestClassifier, "boosted_trees": GBTClassifier}
    ready = VectorAssembler(inputCols=list(features), outputCol="_x").transform(df).withColumn("_y", F.col(label).cast("double"))
    estimator = kinds[method](featuresCol="_x", labelCol="_y", predictionCol="_p", seed=seed, **params)
    model = estimator.fit(ready.filter("NOT is_test").select("_x", "_y"))
    scored = model.transform(ready)
    return scored.withColumn("probability_fraud", vector_to_array("probability")[1]).withColumn(
        "predicted", F.col("_p") == 1.0
    ).select(*df.columns, F.col("probability_fraud"), "predicted")


def regress(df: DataFrame, features: Sequence[str], target: str, seed: int = 42, **params) -> DataFrame:
    """Boosted-tree regression fitted on rows with ``is_test`` false; adds ``forecast``."""
    ready = VectorAssembler(inputCols=list(features), outputCol="_x").transform(df)
    model = GBTRegressor(featuresCol="_x", labelCol=target, predictionCol="forecast", seed=seed, **params).fit(
        ready.filter("NOT is_test")
    )
    return model.transform(ready).drop("_x")


def collaborative_offers(df: DataFrame, client: str, item: str, weight: str, top: int, seed: int = 42, **params) -> DataFrame:
    """Top items per client from implicit-feedback matrix factorization."""
    model = ALS(userCol=client, itemCol=item, ratingCol=weight, implicitPrefs=True, seed=seed, **params).fit(df)
    named = lambda factors, name: factors.select(F.col("id").alias(name), F.col("features").alias("vector"))
    return top_items(named(model.userFactors, client), named(model.itemFactors, item), client, item, "vector", top, cosine=False)


def content_offers(profiles: DataFrame, items: DataFrame, client: str, item: str, vector: str, top: int) -> DataFrame:
    """Top items per client by cosine between client profile and item vector."""
    return top_items(profiles, items, client, item, vector, top, cosine=True)


def top_items(
    profiles: DataFrame, items: DataFrame, client: str, item: str, vector: str, top: int, cosine: bool
) -> DataFrame:
    """The ``top`` items of each client by inner product or cosine.

    The item catalogue is checked to be small and shipped to the tasks, each of
    which keeps only the best items of a client; no client-item pair is emitted
    otherwise. Equal scores are ordered by item.
    """
    rows = items.select(item, vector).limit(MAX_ITEMS + 1).collect()
    if len(rows) > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} items")
    rows.sort(key=lambda r: r[item])
    names = np.array([r[item] for r in rows])
    scale = _unit if cosine else np.asarray
    shared = profiles.sparkSession.sparkContext.broadcast((names, scale(np.array([r[vector] for r in rows], dtype=float))))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order, catalogue = shared.value
        for batch in batches:
            mine = scale(np.stack(batch[vector].to_numpy()).astype(float))
            for start in range(0, len(batch), 1024):
                first, scores = _best_columns(mine[start : start + 1024], catalogue, top)
                count, width = first.shape
                yield pd.DataFrame(
                    {
                        client: np.repeat(batch[client].to_numpy()[start : start + 1024], width),
                        "position": np.tile(np.arange(1, width + 1), count),
                        item: order[first].ravel(),
                        "score": scores.ravel(),
                    }
                )

    kinds = {**dict(items.dtypes), **dict(profiles.dtypes)}
    out = f"{client} {kinds[client]}, position int, {item} {kinds[item]}, score double"
    return profiles.select(client, vector).mapInPandas(best, out)


def _best_columns(rows: np.ndarray, catalogue: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of the ``top`` catalogue rows of each row, equal scores by position.

    The catalogue is taken ``ITEM_BLOCK`` rows at a time, each block reduced to
    its own best by partial selection.
    """
    best = np.zeros((len(rows), 0), np.int64)
    best_scores = np.zeros((len(rows), 0))
    for start in range(0, len(catalogue), ITEM_BLOCK):
        scores = np.round(rows @ catalogue[start : start + ITEM_BLOCK].T, 9)
        width = min(top, scores.shape[1])
        chosen = np.sort(np.argpartition(-scores, width - 1, axis=1)[:, :width], axis=1)
        least = np.take_along_axis(scores, chosen, axis=1).min(axis=1, keepdims=True)
        # a tie at the border: the smaller positions win
        for k in np.flatnonzero((scores >= least).sum(axis=1) > width):
            chosen[k] = np.sort(np.argsort(-scores[k], kind="stable")[:width])
        best = np.concatenate([best, chosen + start], axis=1)
        best_scores = np.concatenate([best_scores, np.take_along_axis(scores, chosen, axis=1)], axis=1)
        order = np.argsort(-best_scores, axis=1, kind="stable")[:, :top]
        best, best_scores = np.take_along_axis(best, order, axis=1), np.take_along_axis(best_scores, order, axis=1)
    return best, best_scores


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
