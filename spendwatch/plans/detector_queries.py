"""Detectors of every kind: trained, stored, loaded, dispatched and put to the vote."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.operators import iforest, lof, ocsvm, votes
from spendwatch.operators.quantiles import exact_quantiles
from spendwatch.operators.sampling import split_exact
from spendwatch.plans import forest_sql
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import sql_draw
from spendwatch.plans.eval_queries import VECTOR, vectors
from spendwatch.session import cut_lineage, release, scratch_path
from spendwatch.sources import modelstore

RUN = "20240131_000000"
TREES, TREE_ROWS, SHARE = 24, 64, 0.1
NEIGHBORS = lof.LOF_NEIGHBORS
SVM = dict(nu=0.1, eta0=1.0, components=16, gamma=0.05, steps=6)
SCORE = "x0"
NAMES = ("isolation_forest", "lof", "one_class_svm", "score_only")
BLOCK_AT = 3


def _svm_sql() -> str:
    """CTEs from ``v(id, is_test, x)`` to ``svm(id, decision)``: the same steps, unrolled."""
    d, nu, steps = SVM["components"], SVM["nu"], SVM["steps"]
    fourier = ocsvm.fourier_map(len(VECTOR), d, SVM["gamma"])
    number = lambda x: f"{float(x)!r}::DOUBLE"
    dots = [" + ".join(f"x[{i + 1}] * ({number(fourier.weights[i, j])})" for i in range(len(VECTOR))) for j in range(d)]
    z = ", ".join(f"{number(math.sqrt(2.0 / d))} * cos({dots[j]} + {number(fourier.shifts[j])})" for j in range(d))
    places = range(1, d + 1)
    ctes = [
        f"sz AS MATERIALIZED (SELECT id, is_test, [{z}] AS z FROM v)",
        f"s0 AS (SELECT [{', '.join(['0.0::DOUBLE'] * d)}] AS w, 0.0::DOUBLE AS b, [{', '.join(['0.0::DOUBLE'] * d)}] AS tw, 0.0::DOUBLE AS tb)",
    ]
    for t in range(steps):
        eta = number(SVM["eta0"] / (1 + t))
        means = ", ".join(f"avg(CASE WHEN a THEN z[{j}] ELSE 0 END)" for j in places)
        ctes.append(f"g{t} AS (SELECT avg(a::INTEGER) AS act, [{means}] AS m FROM (SELECT z, list_dot_product(z, w) + b < 1 AS a FROM sz, s{t} WHERE NOT is_test))")
        new = [f"w[{j}] - {eta} * ({nu} * w[{j}] - m[{j}])" for j in places]
        ctes.append(f"n{t} AS (SELECT [{', '.join(new)}] AS w, b - {eta} * ({nu} - act) AS b, tw, tb FROM s{t}, g{t})")
        ctes.append(f"s{t + 1} AS MATERIALIZED (SELECT w, b, [{', '.join(f'tw[{j}] + w[{j}]' for j in places)}] AS tw, tb + b AS tb FROM n{t})")
    ctes.append(f"svm AS MATERIALIZED (SELECT id, (list_dot_product(z, tw) + tb) / {steps} - 1 AS decision FROM sz, s{steps})")
    return ",\n".join(ctes)


_SQL_VECTORS = f"""v AS MATERIALIZED (SELECT vec_id AS id, embedding::DOUBLE[] AS x,
    row_number() OVER (ORDER BY {sql_draw(42, "vec_id")}, vec_id) <= ceil(count(*) OVER () * 0.15::DOUBLE) AS is_test FROM embeddings)"""

_SQL_LOF = f"""refs AS MATERIALIZED (SELECT id, x FROM v WHERE NOT is_test),
    near AS MATERIALIZED (SELECT a.id AS q, b.id AS o, list_distance(a.x, b.x) AS d FROM refs a JOIN refs b ON a.id <> b.id
        QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) <= {NEIGHBORS}),
    reach AS MATERIALIZED (SELECT q, max(d) AS kd FROM near GROUP BY 1),
    density AS MATERIALIZED (SELECT n.q, 1 / (avg(greatest(r.kd, n.d)) + 1e-10) AS lrd FROM near n JOIN reach r ON n.o = r.q GROUP BY 1),
    factor AS (SELECT n.q, avg(o.lrd) / any_value(s.lrd) AS factor FROM near n JOIN density o ON n.o = o.q JOIN density s ON n.q = s.q GROUP BY 1),
    cut AS (SELECT quantile_cont(-factor, {SHARE}) AS t FROM factor),
    hit AS MATERIALIZED (SELECT a.id AS q, b.id AS o, list_distance(a.x, b.x) AS d FROM v a, refs b
        QUALIFY row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) <= {NEIGHBORS}),
    own AS MATERIALIZED (SELECT h.q AS id, -avg(o.lrd) * (avg(greatest(r.kd, h.d)) + 1e-10) AS score
        FROM hit h JOIN reach r ON h.o = r.q JOIN density o ON h.o = o.q GROUP BY 1)"""

_FLAT = ", ".join(f'x[{i + 1}]::FLOAT AS "{n}"' for i, n in enumerate(VECTOR))
_SQL_LABELS = ",\n".join(
    [
        f"WITH {_SQL_VECTORS}",
        f"flat AS (SELECT id AS row_key, is_test, {_FLAT} FROM v)",
        "seen AS (SELECT * FROM flat WHERE NOT is_test)",
        forest_sql.grow("d", "seen", VECTOR, TREES, 1.0, False, TREE_ROWS),
        forest_sql.walk("d", "flat", VECTOR, TREES, TREE_ROWS, SHARE, "NOT is_test"),
        _SQL_LOF,
        _svm_sql(),
        f"""labels AS MATERIALIZED (SELECT v.id, d_scored.prediction AS isolation_forest, CASE WHEN score_l - t < 0 THEN -1 ELSE 1 END AS lof,
            CASE WHEN svm.decision < 0 THEN -1 ELSE 1 END AS one_class_svm,
            CASE WHEN x[1] < (SELECT quantile_cont(x[1], {SHARE}) FROM v WHERE NOT is_test) THEN -1 ELSE 1 END AS score_only
            FROM v JOIN d_scored ON row_key = id JOIN (SELECT id, score AS score_l FROM own) USING (id) JOIN svm USING (id), cut)""",
    ]
)


def trained_models(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    """The vectors, and the folder where one detector of each kind, fitted on the training part, was stored."""
    rows = cut_lineage(split_exact(vectors(spark, folder), "vec_id"))
    seen, root = rows.filter("NOT is_test"), scratch_path(spark, "detectors")
    forest = iforest.fit_forest(seen, "vec_id", VECTOR, TREES, SHARE, sub_sample=TREE_ROWS)
    modelstore.save(spark, forest, tuple(VECTOR), root, "isolation_forest", RUN)
    outliers = lof.fit_lof(lof.to_points(seen, "vec_id", VECTOR), NEIGHBORS, SHARE)
    modelstore.save(spark, outliers, tuple(VECTOR), root, "lof", RUN)
    release(outliers.points)
    modelstore.save(spark, ocsvm.fit_averaged(seen, VECTOR, **SVM), tuple(VECTOR), root, "one_class_svm", RUN)
    cut = exact_quantiles(seen.select(F.col(SCORE).cast("double").alias(SCORE)), [SCORE], [SHARE]).first()["quantile"]
    modelstore.save(spark, modelstore.Threshold(SCORE, cut), (SCORE,), root, "score_only", RUN)
    return rows, root


def all_labels(spark: SparkSession, folder: str) -> DataFrame:
    """``vec_id`` and the labels of every stored detector, read back and dispatched by kind."""
    rows, root = trained_models(spark, folder)
    return votes.votes(spark, votes.label_tables(rows, "vec_id", modelstore.load_all(spark, root)), "vec_id")


@query("score_all_models", f"{_SQL_LABELS} SELECT * FROM labels")
def score_all_models(spark: SparkSession, folder: str) -> DataFrame:
    return all_labels(spark, folder).withColumnRenamed("vec_id", "id")


@query(
    "comparison_trained",
    f"""{_SQL_LABELS}, long AS (UNPIVOT labels ON {", ".join(NAMES)} INTO NAME model_name VALUE prediction)
    SELECT model_name, count(*) AS total_samples, count_if(prediction = -1) AS anomalies_detected, count_if(prediction = 1) AS normal_samples,
        round(avg((prediction = -1)::INTEGER), 5) AS anomaly_rate FROM long GROUP BY 1""",
)
def comparison_trained(spark: SparkSession, folder: str) -> DataFrame:
    return votes.compared(all_labels(spark, folder), NAMES)


@query(
    "ensemble_trained",
    f"""{_SQL_LABELS}, c AS (SELECT *, {" + ".join(f"({n} = -1)::INTEGER" for n in NAMES)} AS votes, score_only = -1 AND lof = -1 AS rule_hit FROM labels)
    SELECT *, CASE WHEN votes * 2 > {len(NAMES)} THEN -1 ELSE 1 END AS prediction,
        CASE WHEN votes >= {BLOCK_AT} THEN 'block' WHEN votes > 0 OR rule_hit THEN 'alert' ELSE 'allow' END AS action FROM c""",
)
def ensemble_trained(spark: SparkSession, folder: str) -> DataFrame:
    rule = (F.col("score_only") == -1) & (F.col("lof") == -1)
    return votes.decided(all_labels(spark, folder), "vec_id", NAMES, rule, BLOCK_AT).withColumnRenamed("vec_id", "id")


@query("ocsvm_trained", f"WITH {_SQL_VECTORS},\n{_svm_sql()} SELECT id, round(decision, 6) AS decision FROM svm")
def ocsvm_trained(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions of a one-class SVM fitted on the training part, stored and read back."""
    rows = cut_lineage(split_exact(vectors(spark, folder), "vec_id"))
    root = scratch_path(spark, "svm")
    modelstore.save(spark, ocsvm.fit_averaged(rows.filter("NOT is_test"), VECTOR, **SVM), tuple(VECTOR), root, "one_class_svm", RUN)
    model, _ = modelstore.load_all(spark, root)["one_class_svm"]
    return rows.select(F.col("vec_id").alias("id"), F.round(ocsvm.decision(rows, model), 6).alias("decision"))
