import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.operators import classify, detectors, ocsvm, profile, quality


def _clusters(spark, n=150, k=3):
    rng = np.random.default_rng(2)
    label = np.arange(n) % k
    x = rng.normal(size=(n, 3)) + label[:, None] * 2.5 + 1000
    rows = spark.createDataFrame([(i, int(c), *map(float, v)) for i, (c, v) in enumerate(zip(label, x))], "id int, c int, x double, y double, z double")
    return rows, label, x


def _silhouette(label, x, power):
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) ** power
    out = []
    for i, own in enumerate(label):
        mates = (label == own) & (np.arange(len(x)) != i)
        if not mates.any():
            out.append(0.0)
            continue
        a = away[i][mates].mean()
        b = min(away[i][label == other].mean() for other in set(label) - {own})
        out.append((b - a) / max(a, b))
    return np.mean(out)


FEATURES = ["x", "y", "z"]


def test_cluster_scores_match_definitions(spark):
    rows, label, x = _clusters(spark)
    centers = np.array([x[label == c].mean(axis=0) for c in range(3)])
    within = sum(((x[label == c] - centers[c]) ** 2).sum() for c in range(3))
    between = sum((label == c).sum() * ((centers[c] - x.mean(axis=0)) ** 2).sum() for c in range(3))
    ch = (between / 2) / (within / (len(x) - 3))
    assert quality.calinski_harabasz(rows, FEATURES, "c").first()["score"] == pytest.approx(ch, abs=1e-3)
    spread = [np.sqrt(((x[label == c] - centers[c]) ** 2).sum(axis=1)).mean() for c in range(3)]
    db = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(centers[i] - centers[j]) for j in range(3) if j != i) for i in range(3)])
    assert quality.davies_bouldin(rows, FEATURES, "c").first()["score"] == pytest.approx(db, abs=1e-4)
    got = quality.silhouette_euclidean(rows, FEATURES, "c", "id").first()
    assert got["n_rows"] == 150 and got["score"] == pytest.approx(_silhouette(label, x, 1), abs=1e-4)
    assert quality.silhouette_squared(rows, FEATURES, "c").first()["score"] == pytest.approx(_silhouette(label, x, 2), abs=1e-4)


def test_silhouette_sample_has_the_asked_size(spark):
    rows, _, _ = _clusters(spark)
    assert quality.silhouette_euclidean(rows, FEATURES, "c", "id", rows=40).first()["n_rows"] == 40


def test_single_cluster_and_lonely_member(spark):
    rows, _, _ = _clusters(spark)
    one = rows.withColumn("c", F.lit(1))
    assert quality.calinski_harabasz(one, FEATURES, "c").first()["score"] is None
    assert quality.davies_bouldin(one, FEATURES, "c").first()["score"] is None
    lonely = rows.withColumn("c", F.when(F.col("id") == 0, 9).otherwise(F.col("c") % 2))
    data = lonely.toPandas()
    want = _silhouette(data.c.to_numpy(), data[FEATURES].to_numpy(), 2)
    assert quality.silhouette_squared(lonely, FEATURES, "c").first()["score"] == pytest.approx(want, abs=1e-4)


def test_summary_rounding(spark):
    rows = spark.createDataFrame([(-1,), (1,), (1,)], "prediction int")
    assert tuple(quality.anomaly_summary(rows).first()) == (3, 1, 2, 0.33333, 2)


def test_histogram_area_and_constant_label(spark):
    rows = spark.range(1_000).select((F.col("id") % 2).alias("l"), F.when(F.col("id") % 2 == 0, 4.0).otherwise(F.col("id") / 10).alias("v"))
    bins = profile.density_histogram(rows, "v", "l").collect()
    flat = [b for b in bins if b["label"] == 0]
    assert [(b["bin"], b["rows_in_bin"], b["density"]) for b in flat] == [(0, 500, None)]
    wide = [b for b in bins if b["label"] == 1]
    assert sum(b["rows_in_bin"] for b in wide) == 500 and max(b["bin"] for b in wide) == 99
    width = (99.9 - 0.1) / 100
    assert sum(b["density"] * width for b in wide) == pytest.approx(1.0)


def test_density_curve_integrates_to_one(spark):
    rows = spark.range(500).select(F.lit("a").alias("l"), (F.pmod(F.col("id") * 31, F.lit(97)) / 9.0).alias("v"))
    curve = profile.density_curve(rows, "v", "l").orderBy("point").collect()
    assert len(curve) == 200
    area = np.trapezoid([c["density"] for c in curve], [c["x"] for c in curve])
    assert area == pytest.approx(1.0, abs=0.01)


def test_best_model_first_wins_ties(spark):
    rows = spark.createDataFrame([("b", 1, 5.0), ("a", 0, 5.0), ("c", 2, 1.0)], "model_name string, position int, throughput double")
    assert detectors.best_model(rows, "position").first()["model_name"] == "a"


def test_confusion_without_positives(spark):
    rows = spark.createDataFrame([(False, False)], "a boolean, p boolean")
    got = classify.confusion_metrics(rows, "a", "p").first()
    assert got["precision"] is None and got["recall"] is None and got["meets_targets"] is False


def test_welch_and_drift(spark):
    rows = spark.range(200).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"), (F.col("id") % 13 + F.col("id") % 2).cast("double").alias("v"))
    data = rows.toPandas()
    a, b = data.v[data.g == "a"], data.v[data.g == "b"]
    want = (b.mean() - a.mean()) / np.sqrt(a.var() / len(a) + b.var() / len(b))
    assert classify.compare_groups(rows, "g", "v", "a", "b").first()["t_statistic"] == pytest.approx(want)
    same = classify.population_stability(rows, rows, ["v"]).first()["psi"]
    moved = classify.population_stability(rows, rows.withColumn("v", F.col("v") + 5), ["v"]).first()["psi"]
    assert same == pytest.approx(0.0) and moved > 0.25


def test_one_class_svm_learns_the_bulk(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 0.5, (400, 2)), rng.uniform(6, 9, (8, 2))])
    rows = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double")
    model, losses = ocsvm.fit_ocsvm(rows, ["a", "b"], gamma=0.5, steps=25)
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]
    scored = rows.select("a", ocsvm.decision(rows, model).alias("d")).collect()
    bulk = np.mean([r["d"] < 0 for r in scored if r["a"] < 4])
    assert bulk < 0.25 and all(r["d"] < 0 for r in scored if r["a"] > 4)


def test_unknown_detector_types_are_ignored():
    assert detectors.known_types(["lof", "prophet", "isolation_forest"]) == ["lof", "isolation_forest"]
