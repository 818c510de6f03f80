"""Local outlier factors and one-class SVM over the embedding vectors."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.functions.decisions import label_from_decision
from spendwatch.functions.hashing import unit_draw
from spendwatch.operators import lof as lof_
from spendwatch.operators import ocsvm
from spendwatch.operators.sampling import split_exact
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import sql_draw
from spendwatch.plans.eval_queries import VECTOR, vectors


def _lof_sql(points: str, k: int) -> str:
    """CTEs from ``points(id, grp, x)`` to ``factor(q, grp, factor)``."""
    return f"""near AS MATERIALIZED (SELECT q, grp, o, d FROM (
        SELECT a.id AS q, a.grp, b.id AS o, list_distance(a.x, b.x) AS d FROM {points} a JOIN {points} b ON a.grp = b.grp AND a.id <> b.id)
        QUALIFY row_number() OVER (PARTITION BY q ORDER BY d, o) <= {k}),
    reach AS (SELECT q, max(d) AS kd FROM near GROUP BY 1),
    density AS MATERIALIZED (SELECT n.q, 1 / (avg(greatest(r.kd, n.d)) + 1e-10) AS lrd FROM near n JOIN reach r ON n.o = r.q GROUP BY 1),
    factor AS MATERIALIZED (SELECT n.q, any_value(n.grp) AS grp, avg(o.lrd) / any_value(s.lrd) AS factor
        FROM near n JOIN density o ON n.o = o.q JOIN density s ON n.q = s.q GROUP BY 1)"""


@query(
    "lof",
    f"""WITH pts AS (SELECT vec_id AS id, 0 AS grp, embedding::DOUBLE[] AS x FROM embeddings), {_lof_sql("pts", 25)}
    SELECT q AS id, round(factor, 6) AS factor,
           CASE WHEN -factor - (SELECT quantile_cont(-factor, 0.1) FROM factor) < 0 THEN -1 ELSE 1 END AS prediction FROM factor""",
)
def lof(spark: SparkSession, folder: str) -> DataFrame:
    points = lof_.to_points(vectors(spark, folder), "vec_id", VECTOR)
    labels = lof_.fitted_labels(points, lof_.fit_lof(points))
    return labels.select("id", F.round("factor", 6).alias("factor"), "prediction")


@query(
    "hier_lof",
    f"""WITH v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS x,
        row_number() OVER (ORDER BY {sql_draw(42, "vec_id")}, vec_id) <= ceil(count(*) OVER () * 0.15::DOUBLE) AS is_test FROM embeddings),
    c AS (SELECT label, list(m ORDER BY i) AS m FROM (SELECT label, i, avg(x[i + 1]) AS m FROM v, range(64) r(i) WHERE NOT is_test GROUP BY 1, 2) GROUP BY 1),
    a AS MATERIALIZED (SELECT v.*, c.label AS grp FROM v, c QUALIFY row_number() OVER (PARTITION BY id ORDER BY list_distance(x, m), c.label) = 1),
    refs AS MATERIALIZED (SELECT id, grp, x FROM a WHERE NOT is_test), {_lof_sql("refs", 20)},
    cut AS (SELECT grp, quantile_cont(-factor, 0.1) AS t FROM factor GROUP BY 1),
    hit AS MATERIALIZED (SELECT a.id AS q, a.grp, b.id AS o, list_distance(a.x, b.x) AS d FROM a JOIN refs b ON a.grp = b.grp WHERE a.is_test
        QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) <= 20),
    own AS (SELECT h.q, any_value(h.grp) AS grp, avg(o.lrd) AS theirs, 1 / (avg(greatest(r.kd, h.d)) + 1e-10) AS mine
        FROM hit h JOIN reach r ON h.o = r.q JOIN density o ON h.o = o.q GROUP BY 1)
    SELECT q AS id, own.grp AS cluster, round(-theirs / mine, 6) AS score, CASE WHEN -theirs / mine - t >= 0 THEN 1 ELSE -1 END AS prediction
    FROM own JOIN cut ON own.grp = cut.grp""",
)
def hier_lof(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows against the local outlier model of their nearest cluster."""
    rows = split_exact(vectors(spark, folder), "vec_id")
    means = rows.filter("NOT is_test").groupBy("label").agg(F.expr("array(" + ", ".join(f"avg(cast({x} as double))" for x in VECTOR) + ")").alias("m"))
    centroids = {r["label"]: r["m"] for r in means.collect()}  # one row per cluster
    grouped = lof_.nearest_centroid(rows, VECTOR, centroids)
    model = lof_.fit_lof(
        lof_.to_points(rows.filter("NOT is_test"), "vec_id", VECTOR, grouped), k=lof_.CLUSTERED_NEIGHBORS
    )
    held_out = lof_.to_points(rows.filter("is_test"), "vec_id", VECTOR, grouped)
    return lof_.score_lof(held_out, model).select(
        "id", F.col("grp").cast("int").alias("cluster"), F.round("score", 6).alias("score"), "prediction"
    )


_SVM_FEATURES = VECTOR
_SVM_COMPONENTS = 16


def stored_svm() -> ocsvm.OneClassSvm:
    """A small model with weights given by rule, as if read from a model table."""
    weights = np.array([unit_draw("svm:weight", j) - 0.4 for j in range(_SVM_COMPONENTS)])
    return ocsvm.OneClassSvm(
        tuple(_SVM_FEATURES), ocsvm.fourier_map(len(_SVM_FEATURES), _SVM_COMPONENTS, 0.05), weights, 1.0
    )


def _svm_sql() -> str:
    model = stored_svm()
    terms = []
    for j in range(_SVM_COMPONENTS):
        dot = " + ".join(
            f"embedding[{i + 1}]::DOUBLE * ({float(model.fourier.weights[i, j])!r}::DOUBLE)" for i in range(len(_SVM_FEATURES))
        )
        scale = float(model.weights[j]) * math.sqrt(2.0 / _SVM_COMPONENTS)
        terms.append(f"({scale!r}::DOUBLE) * cos({dot} + {float(model.fourier.shifts[j])!r}::DOUBLE)")
    total = " + ".join(terms)
    return f"""SELECT vec_id AS id, round(d, 6) AS decision, CASE WHEN d >= 0 THEN 1 ELSE -1 END AS prediction
        FROM (SELECT vec_id, {total} AS d FROM embeddings)"""


@query("ocsvm_score", _svm_sql())
def ocsvm_score(spark: SparkSession, folder: str) -> DataFrame:
    rows = vectors(spark, folder)
    scored = rows.withColumn("decision", ocsvm.decision(rows, stored_svm()))
    return scored.select(
        F.col("vec_id").alias("id"),
        F.round("decision", 6).alias("decision"),
        label_from_decision(F.col("decision")).alias("prediction"),
    )


@query("ocsvm_fit", "SELECT count(*) AS n_rows, true AS loss_fell, true AS share_as_asked FROM embeddings")
def ocsvm_fit(spark: SparkSession, folder: str) -> DataFrame:
    """Whether fitting lowers the loss, and leaves about the asked share of fitted rows outside."""
    rows = vectors(spark, folder)
    model, losses = ocsvm.fit_ocsvm(rows, VECTOR, gamma=0.01)
    scored = rows.withColumn("decision", ocsvm.decision(rows, model))
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.lit(losses[-1] < losses[0]).alias("loss_fell"),
        F.avg((F.col("decision") < 0).cast("int")).between(0.02, 0.3).alias("share_as_asked"),
    )
