"""Trained detectors of every kind as Parquet tables, one partition per run.

A run is a model type and a time stamp. Its folders are written anew, so saving
it again changes nothing; the row in ``runs``, written last, makes it visible.
Reference points of local outlier models stay distributed on both ways; what
the other kinds hold has a size fixed by their parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.operators.iforest import NODE_SCHEMA, Forest
from spendwatch.operators.lof import LofModel
from spendwatch.operators.ocsvm import FourierMap, OneClassSvm

RUNS_SCHEMA = "kind string, features array<string>, numbers array<double>, counts array<int>"


@dataclass(frozen=True)
class Threshold:
    """A detector that only has scores: rows of the scored column below the cut are anomalous."""

    column: str
    cut: float


Model = Forest | LofModel | OneClassSvm | Threshold


def _folder(root: str, table: str, model_type: str, run_ts: str) -> str:
    return f"{root}/{table}/model_type={model_type}/run_ts={run_ts}"


def save(spark: SparkSession, model: Model, features: tuple[str, ...], root: str, model_type: str, run_ts: str) -> None:
    """Store one trained detector under its type and run."""
    put = lambda df, table: df.write.mode("overwrite").parquet(_folder(root, table, model_type, run_ts))
    if isinstance(model, Forest):
        put(spark.createDataFrame(list(model.nodes), NODE_SCHEMA).coalesce(1), "nodes")
        row = ("forest", [model.offset, model.contamination], [model.trees, model.sub_sample, len(model.nodes)])
    elif isinstance(model, LofModel):
        put(model.points.select("rid", "grp", "x", "w", "k_distance", "density", "factor"), "points")
        put(model.offsets.select("grp", "offset"), "offsets")
        row = ("lof", [], [model.k])
    elif isinstance(model, OneClassSvm):
        width = len(model.weights)
        rows = [(j, model.fourier.weights[:, j].tolist(), float(model.fourier.shifts[j]), float(model.weights[j])) for j in range(width)]
        put(spark.createDataFrame(rows, "position int, direction array<double>, shift double, weight double").coalesce(1), "fourier")
        row = ("svm", [model.intercept], [width])
    elif isinstance(model, Threshold):
        row = ("threshold", [model.cut], [])
        features = (model.column,)
    else:
        raise TypeError(f"no table layout for {type(model).__name__}")
    kind, numbers, counts = row
    put(spark.createDataFrame([(kind, list(features), [float(n) for n in numbers], counts)], RUNS_SCHEMA).coalesce(1), "runs")


def runs(spark: SparkSession, root: str) -> DataFrame:
    """``model_type, run_ts`` and the description of every stored run."""
    return spark.read.schema(f"{RUNS_SCHEMA}, model_type string, run_ts string").parquet(f"{root}/runs")


def load(spark: SparkSession, root: str, run) -> tuple[Model, tuple[str, ...]]:
    """The detector that a row of :func:`runs` describes, dispatched by its kind, and its features."""
    read = lambda table: spark.read.parquet(_folder(root, table, run["model_type"], run["run_ts"]))
    features = tuple(run["features"])
    if run["kind"] == "forest":
        trees, sub_sample, nodes = run["counts"]
        records = tuple(tuple(r) for r in read("nodes").select("tree", "node", "feature", "split", "size", "path").collect())
        if len(records) != nodes:
            raise ValueError(f"model {run['model_type']} {run['run_ts']} is incomplete; save it again")
        return Forest(features, records, trees, sub_sample, *run["numbers"]), features
    if run["kind"] == "lof":
        return LofModel(read("points"), read("offsets"), run["counts"][0]), features
    if run["kind"] == "svm":
        rows = sorted(read("fourier").collect(), key=lambda r: r["position"])
        if len(rows) != run["counts"][0]:
            raise ValueError(f"model {run['model_type']} {run['run_ts']} is incomplete; save it again")
        fourier = FourierMap(np.array([r["direction"] for r in rows]).T, np.array([r["shift"] for r in rows]))
        return OneClassSvm(features, fourier, np.array([r["weight"] for r in rows]), run["numbers"][0]), features
    if run["kind"] == "threshold":
        return Threshold(features[0], run["numbers"][0]), features
    raise ValueError(f"unknown kind of model {run['kind']}")


def load_all(spark: SparkSession, root: str, newest: bool = True) -> dict[str, tuple[Model, tuple[str, ...]]]:
    """Every stored detector by ``type`` (its newest run) or, with ``newest`` false, by ``type run``."""
    found = runs(spark, root)
    if newest:
        last = found.groupBy("model_type").agg(F.max("run_ts").alias("run_ts"))
        found = found.join(last, ["model_type", "run_ts"])
    rows = sorted(found.collect(), key=lambda r: (r["model_type"], r["run_ts"]))
    return {r["model_type"] if newest else f"{r['model_type']} {r['run_ts']}": load(spark, root, r) for r in rows}
