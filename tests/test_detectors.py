"""Stored detectors of every kind, dispatch, and votes that meet without a shuffle."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.operators import iforest, lof, ocsvm, votes
from spendwatch.sources import modelstore

FEATURES = ("a", "b")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    points = [(int(k), float(x), float(y)) for k, (x, y) in enumerate(np.vstack([rng.normal(size=(380, 2)), rng.normal(size=(20, 2)) * 8]))]
    return spark.createDataFrame(points, "id bigint, a double, b double")


@pytest.fixture(scope="module")
def models(spark, rows):
    forest = iforest.fit_forest(rows, "id", FEATURES, 20, 0.1, sub_sample=64)
    svm = ocsvm.fit_averaged(rows, FEATURES, components=16, gamma=0.2, steps=5)
    return {"isolation_forest": forest, "lof": lof.fit_lof(lof.to_points(rows, "id", FEATURES), 10), "one_class_svm": svm, "score_only": modelstore.Threshold("a", -1.0)}


def _labels(df):
    return {r["id"]: tuple(r)[1:] for r in df.collect()}


def test_every_kind_survives_the_tables(spark, rows, models, tmp_path):
    root = str(tmp_path)
    for name, model in models.items():
        modelstore.save(spark, model, FEATURES, root, name, "20240101_000000")
        modelstore.save(spark, model, FEATURES, root, name, "20240101_000000")  # a retry changes nothing
    loaded = modelstore.load_all(spark, root)
    assert list(loaded) == sorted(models)
    for name, (model, features) in loaded.items():
        assert type(model) is type(models[name])
        assert _labels(votes.label_rows(rows, "id", model, features)) == _labels(votes.label_rows(rows, "id", models[name], FEATURES))


def test_newest_run_of_each_type(spark, tmp_path):
    for run, cut in (("20240101_000000", 1.0), ("20240301_000000", 3.0), ("20240201_000000", 2.0)):
        modelstore.save(spark, modelstore.Threshold("a", cut), FEATURES, str(tmp_path), "score_only", run)
    assert modelstore.load_all(spark, str(tmp_path))["score_only"][0].cut == 3.0
    assert len(modelstore.load_all(spark, str(tmp_path), newest=False)) == 3


def test_an_incomplete_run_is_refused(spark, models, tmp_path):
    modelstore.save(spark, models["one_class_svm"], FEATURES, str(tmp_path), "one_class_svm", "1")
    folder = f"{tmp_path}/fourier/model_type=one_class_svm/run_ts=1"
    spark.read.parquet(folder).filter("position > 3").write.parquet(f"{folder}-less")
    kept = spark.read.parquet(f"{folder}-less").collect()
    spark.createDataFrame(kept).write.mode("overwrite").parquet(folder)
    with pytest.raises(ValueError, match="incomplete"):
        modelstore.load_all(spark, str(tmp_path))
    with pytest.raises(TypeError):
        modelstore.save(spark, object(), FEATURES, str(tmp_path), "x", "1")


def test_votes_meet_without_a_shuffle(spark, rows, models):
    tables = votes.label_tables(rows, "id", {n: (m, FEATURES) for n, m in models.items()}, buckets=4)
    voted = votes.votes(spark, tables, "id")
    made = votes.decided(voted, "id", list(tables), F.col("score_only") == -1, 3)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
    each = {n: _labels(votes.label_rows(rows, "id", m, FEATURES)) for n, m in models.items()}
    for r in made.collect():
        labels = [each[n][r["id"]][0] for n in tables]
        assert [r[n] for n in tables] == labels and r["votes"] == labels.count(-1)
        assert r["prediction"] == (-1 if labels.count(-1) > 2 else 1)
        assert r["action"] == ("block" if labels.count(-1) >= 3 else "alert" if labels.count(-1) else "allow")
    compared = {r["model_name"]: r["anomalies_detected"] for r in votes.compared(voted, list(tables)).collect()}
    assert compared == {n: sum(v == (-1,) for v in labels.values()) for n, labels in each.items()}


def test_averaged_svm_is_the_plain_descent(rows):
    got = ocsvm.fit_averaged(rows.repartition(7), FEATURES, nu=0.1, eta0=1.0, components=8, gamma=0.3, steps=4)
    x = np.array([[r["a"], r["b"]] for r in rows.collect()])
    z = ocsvm.project(x, got.fourier.weights, got.fourier.shifts)
    w, b, ws, bs = np.zeros(8), 0.0, [], []
    for t in range(4):
        active = z @ w + b < 1
        w, b = w - (0.1 * w - (z * active[:, None]).mean(0)) / (1 + t), b - (0.1 - active.mean()) / (1 + t)
        ws.append(w)
        bs.append(b)
    assert np.allclose(got.weights, np.mean(ws, 0), atol=1e-10) and abs(got.intercept - np.mean(bs)) < 1e-10
    empty = ocsvm.fit_averaged(rows.limit(0), FEATURES, components=4, steps=2)
    assert np.isfinite(empty.weights).all()
