"""Linear one-class SVM on random Fourier features.

Features follow Rahimi and Recht (NIPS 2007). Both the projection and the
weights have a size fixed by parameters, so scoring is one Arrow-batched
function over the table and fitting is one aggregation per step.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions.hashing import unit_draw
from spendwatch.functions.sqltext import ident
from spendwatch.session import cut_lineage

# Parameters of the detector.
NU = 0.1
ETA0 = 0.01
COMPONENTS = 100
GAMMA = 1.0
ADAPTIVE_SHRINK = 5.0
FULL_PASS = 100


@dataclass(frozen=True)
class FourierMap:
    """Projection ``sqrt(2/D) cos(x W + b)`` approximating a Gaussian kernel."""

    weights: np.ndarray
    shifts: np.ndarray


@dataclass(frozen=True)
class OneClassSvm:
    features: tuple[str, ...]
    fourier: FourierMap
    weights: np.ndarray
    intercept: float


def project(x: np.ndarray, weights: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    return math.sqrt(2.0 / len(shifts)) * np.cos(x @ weights + shifts)


def fourier_map(features: int, components: int = COMPONENTS, gamma: float = GAMMA, seed: object = 42) -> FourierMap:
    """Projection drawn from hashes, so it is the same on every run and engine."""
    weights = np.zeros((features, components))
    for i in range(features):
        for j in range(components):
            u, v = unit_draw(f"{seed}:radius", i, j), unit_draw(f"{seed}:angle", i, j)
            normal = math.sqrt(-2.0 * math.log(1.0 - u)) * math.cos(2.0 * math.pi * v)
            weights[i, j] = math.sqrt(2.0 * gamma) * normal
    shifts = np.array([2.0 * math.pi * unit_draw(f"{seed}:shift", j) for j in range(components)])
    return FourierMap(weights, shifts)


def decision(df: DataFrame, model: OneClassSvm) -> Column:
    """Signed distance to the boundary; below 0 is anomalous."""
    # Plain arrays only: executors need not know this package's classes.
    fourier = model.fourier
    shared = df.sparkSession.sparkContext.broadcast((fourier.weights, fourier.shifts, model.weights, model.intercept))

    @F.pandas_udf("double")
    def margin(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        directions, shifts, weights, intercept = shared.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(project(x, directions, shifts) @ weights + intercept - 1.0)

    return margin(*[F.col(ident(f)) for f in model.features])


def fit_ocsvm(
    df: DataFrame,
    features: Sequence[str],
    nu: float = NU,
    eta0: float = ETA0,
    components: int = COMPONENTS,
    gamma: float = GAMMA,
    steps: int = 20,
    seed: object = 42,
) -> tuple[OneClassSvm, list[float]]:
    """Subgradient descent on ``nu/2 |w|^2 + nu b + mean(max(0, 1 - w z - b))``.

    Each step sums the active rows' features in the tasks and adds the partial
    sums in Spark: what reaches the driver is one vector. One step stands for a
    whole pass of per-row updates, so it is ``FULL_PASS`` times ``eta0`` long;
    it shrinks fivefold whenever the loss stops falling.
    """
    names = tuple(features)
    fourier = fourier_map(len(names), components, gamma, seed)
    rows = cut_lineage(df.selectExpr(*[f"cast({ident(f)} as double) AS {ident(f)}" for f in names]))
    context = df.sparkSession.sparkContext

    def evaluate(weights: np.ndarray, intercept: float) -> tuple[float, float, np.ndarray]:
        shared = context.broadcast((fourier.weights, fourier.shifts, weights, intercept))

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            directions, shifts, w, b = shared.value
            sums = np.zeros(len(w) + 3)
            for batch in batches:
                z = project(batch.to_numpy(dtype=float), directions, shifts)
                slack = 1.0 - z @ w - b
                active = slack > 0
                sums += np.concatenate([[len(z), slack[active].sum(), active.sum()], z[active].sum(axis=0)])
            yield pd.DataFrame({"position": np.arange(len(sums)), "value": sums})

        added = rows.mapInPandas(partial, "position int, value double").groupBy("position").agg(F.sum("value").alias("value"))
        sums = np.array([r["value"] for r in sorted(added.collect(), key=lambda r: r["position"])])
        shared.unpersist()
        n = max(sums[0], 1.0)
        loss = nu / 2 * float(weights @ weights) + nu * intercept + sums[1] / n
        return loss, sums[2] / n, sums[3:] / n

    weights, intercept, eta = np.zeros(components), 0.0, eta0 * FULL_PASS
    loss, active, mean = evaluate(weights, intercept)
    losses = [loss]
    for _ in range(steps):
        next_weights = weights - eta * (nu * weights - mean)
        next_intercept = intercept - eta * (nu - active)
        found = evaluate(next_weights, next_intercept)
        if found[0] < loss:
            weights, intercept = next_weights, next_intercept
            loss, active, mean = found
            losses.append(loss)
        else:
            eta /= ADAPTIVE_SHRINK
    return OneClassSvm(names, fourier, weights, intercept), losses


def fit_averaged(
    df: DataFrame,
    features: Sequence[str],
    nu: float = NU,
    eta0: float = 1.0,
    components: int = COMPONENTS,
    gamma: float = GAMMA,
    steps: int = 20,
    seed: object = 42,
) -> OneClassSvm:
    """Averaged subgradient descent with a fixed, shrinking step and no feedback.

    The projected rows are written once. A step is one native aggregation with
    the current weights as constants, so it runs in the JVM and its result does
    not depend on partitioning; the driver holds ``components`` numbers. The
    returned weights are the mean of all steps' weights.
    """
    names = tuple(features)
    fourier = fourier_map(len(names), components, gamma, seed)
    shared = df.sparkSession.sparkContext.broadcast((fourier.weights, fourier.shifts))

    @F.pandas_udf("array<double>")
    def projected(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        directions, shifts = shared.value
        for columns in batches:
            yield pd.Series(list(project(np.column_stack([c.to_numpy(dtype=float) for c in columns]), directions, shifts)))

    z = [f"z{j}" for j in range(components)]
    made = df.select(projected(*[F.col(ident(f)) for f in names]).alias("z"))
    rows = cut_lineage(made.select(*[F.element_at("z", j + 1).alias(c) for j, c in enumerate(z)]))
    weights, intercept = np.zeros(components), 0.0
    total, total_intercept = np.zeros(components), 0.0
    for step in range(steps):
        margin = F.lit(float(intercept))
        for c, w in zip(z, weights):
            margin = margin + F.col(c) * F.lit(float(w))
        active = margin < 1.0
        sums = rows.agg(
            F.coalesce(F.avg(active.cast("int")), F.lit(0.0)).alias("active"),
            *[F.coalesce(F.avg(F.when(active, F.col(c)).otherwise(0.0)), F.lit(0.0)).alias(c) for c in z],
        ).first()
        eta = eta0 / (1 + step)
        weights = weights - eta * (nu * weights - np.array([sums[c] for c in z]))
        intercept = intercept - eta * (nu - sums["active"])
        total, total_intercept = total + weights, total_intercept + intercept
    return OneClassSvm(names, fourier, total / steps, float(total_intercept / steps))
