import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.functions import decisions
from spendwatch.operators import iforest, scoring
from spendwatch.plans import eval_queries
from spendwatch.sources import registry


def _matrix(spark, n=3_000):
    """Two dense blobs, ten far points, a constant column."""
    x = (F.pmod(F.col("id") * 7919, F.lit(997)) / 997.0 + F.when(F.col("id") % 2 == 0, 5).otherwise(0)).cast("float")
    y = (F.pmod(F.col("id") * 104729, F.lit(991)) / 991.0).cast("float")
    far = F.col("id") < 10
    return spark.range(n).select(
        F.col("id").alias("row_key"),
        F.when(far, F.lit(60.0) + F.col("id")).otherwise(x).cast("float").alias("x"),
        F.when(far, -50.0).otherwise(y).cast("float").alias("y"),
        F.lit(3.0).cast("float").alias("same"),
    )


def test_average_path_values():
    assert iforest.average_path(1) == 0.0 and iforest.average_path(2) == 1.0
    assert iforest.average_path(256) == pytest.approx(10.244, abs=1e-3)


@pytest.mark.parametrize("bootstrap", [True, False])
def test_forest_is_independent_of_partitioning(spark, bootstrap):
    args = dict(trees=12, sub_sample=64, bootstrap=bootstrap, max_features=0.7)
    grown = []
    for parts in (2, 16):
        nodes, used = iforest.fit_nodes(_matrix(spark).repartition(parts), "row_key", ["x", "y", "same"], **args)
        assert used == 64
        grown.append(sorted(tuple(r) for r in nodes.collect()))
    assert grown[0] == grown[1]
    assert {r[0] for r in grown[0]} == set(range(12))
    roots = [r for r in grown[0] if r[1] == 1]
    assert all(r[4] == 64 for r in roots)
    assert all(r[2] != 2 for r in grown[0]), "a constant column cannot split"


def test_small_input_without_replacement_uses_every_row(spark):
    nodes, used = iforest.fit_nodes(_matrix(spark, 40), "row_key", ["x", "y"], trees=3)
    assert used == 40
    assert all(r["size"] == 40 for r in nodes.filter("node = 1").collect())


def test_drawn_rows_are_those_of_the_whole_hash_order(spark):
    from spendwatch.operators.sampling import dense_index, rows_at_positions

    rows = spark.range(3_000).repartition(7)
    wanted = spark.createDataFrame([(n,) for n in (0, 1, 5, 5, 1_499, 2_998, 2_999)], "row_index bigint")
    found = {(r["row_index"], r["id"]) for r in rows_at_positions(rows, "id", "s", wanted).collect()}
    whole = {(r["row_index"], r["id"]) for r in dense_index(rows, "id", "s").collect()}
    assert found == {p for p in whole if p[0] in (0, 1, 5, 1_499, 2_998, 2_999)}


def test_outliers_score_highest_and_share_matches(spark):
    matrix = _matrix(spark)
    forest = iforest.fit_forest(matrix, "row_key", ["x", "y", "same"], trees=100, contamination=0.01)
    scored = iforest.with_scores(matrix, forest).cache()
    worst = {r["row_key"] for r in scored.orderBy("score", "row_key").limit(10).collect()}
    assert worst == set(range(10))
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert -1.0 < low < high < 0.0
    flagged = scored.filter("decision < 0").count()
    assert 10 <= flagged <= 30


def test_vector_walk_equals_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 4)).astype(np.float32).astype(float)
    nodes = iforest.grow_tree(x[:64], 0, [0, 1, 2, 3], 6, 1)
    forest = iforest.Forest(("a", "b", "c", "d"), tuple(nodes), 1, 64, 0.0, 0.1)
    by_id = {n[1]: n for n in nodes}
    want = []
    for row in x:
        node = 1
        while by_id[node][2] >= 0:
            node = 2 * node + int(row[by_id[node][2]] > by_id[node][3])
        want.append(by_id[node][5])
    assert np.allclose(iforest.path_lengths(x, *iforest._tables(forest)), np.round(want, 9))


def _detector(spark):
    rows = spark.range(2_000).select(
        F.col("id").alias("id_transaction"),
        (F.col("id") % 17).alias("client_id"),
        F.when(F.col("id") < 5, 9_000.0).otherwise(F.col("id") % 90 + 10.0).alias("amount"),
        F.when(F.col("id") % 2 == 0, "Chip Transaction").otherwise("Online Transaction").alias("use_chip"),
        F.when(F.col("id") % 3 == 0, "Male").otherwise("Female").alias("gender"),
        (F.col("id") % 24).alias("transaction_hour"),
    )
    matrix, categories = scoring.prepare_training(rows, "id_transaction", fraction=1.0)
    detector = scoring.train(matrix, categories, "20250101_000000", trees=60, contamination=0.02, max_features=0.8, bootstrap=True)
    return rows, matrix, detector


def test_training_matrix_and_detector_round_trip(spark, tmp_path):
    rows, matrix, detector = _detector(spark)
    assert detector.features == ("amount", "transaction_hour", "use_chip_Online Transaction", "gender_Male")
    assert matrix.filter("is_test").count() == 300
    root = str(tmp_path / "models")
    registry.save_detector(spark, detector, root, "20250101_000000")
    registry.save_detector(spark, detector, root, "20240101_000000")
    restored = registry.latest_detector(spark, root)
    assert registry.status(restored) == {
        "type": "isolation_forest", "path": "20250101_000000", "features_count": 4, "has_scaler": True,
    }
    assert sorted(restored.forest.nodes) == sorted(detector.forest.nodes)
    before = scoring.score(rows, detector, ["id_transaction"]).orderBy("id_transaction").collect()
    after = scoring.score(rows, restored, ["id_transaction"]).orderBy("id_transaction").collect()
    assert before == after
    with pytest.raises(ValueError, match="no usable model"):
        registry.load_detector(spark, root, "lof", "20250101_000000")


def test_scoring_adds_no_shuffle_and_labels_every_row(spark):
    rows, _, detector = _detector(spark)
    scored = scoring.score(rows, detector, ["id_transaction"])
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = scored.collect()
    assert len(got) == 2_000 and {r["prediction"] for r in got} == {decisions.ANOMALY, decisions.NORMAL}
    assert all((r["prediction"] == -1) == (r["prediction_label"] == "ANOMALIA") for r in got)
    assert all(0.5 <= r["confidence_score"] < 1 for r in got)
    assert all(r["prediction"] == -1 for r in got if r["id_transaction"] < 5)


def test_single_records_missing_features_and_failures(spark):
    _, _, detector = _detector(spark)
    records = [
        json.dumps({"id_transaction": 1, "amount": 8750.0, "use_chip": "Online Transaction", "gender": "Male", "transaction_hour": 2}),
        json.dumps({"id_transaction": 2, "amount": 45.75, "transaction_hour": 23}),
        json.dumps({"id_transaction": 3, "amount": 45.75, "use_chip": "other", "gender": None}),
        '{"id_transaction": 4, "amou',
    ]
    text = spark.createDataFrame([(r,) for r in records], "body string")
    got = scoring.score_json(text, "body", detector, "id_transaction").collect()
    assert [r["success"] for r in got] == [True, True, True, False]
    assert got[0]["prediction"] == -1
    assert got[3]["prediction"] is None and got[3]["prediction_label"] is None
    assert got[3]["confidence_score"] == 0.0 and "amou" in got[3]["error"]
    opened = scoring.score_json(text, "body", detector, "id_transaction", fail_open=True).collect()[3]
    assert (opened["prediction"], opened["prediction_label"], opened["success"]) == (1, "NORMAL", False)


def test_a_model_without_scaler_is_served_unscaled(spark, tmp_path):
    rows, matrix, _ = _detector(spark)
    categories = {"use_chip": ["Chip Transaction", "Online Transaction"], "gender": ["Female", "Male"]}
    bare = scoring.train(matrix, categories, "r", scaled=False, trees=10, contamination=0.05)
    registry.save_detector(spark, bare, str(tmp_path / "m"), "r")
    restored = registry.load_detector(spark, str(tmp_path / "m"), "isolation_forest", "r")
    assert restored.scaler is None and not registry.status(restored)["has_scaler"]
    assert scoring.score(rows, restored, ["id_transaction"]).count() == 2_000


def test_artifact_listing(spark, tmp_path):
    for name in ("isolation_forest_1.joblib", "lof_1.joblib", "old.pkl"):
        (tmp_path / name).write_bytes(b"x")
    listed = registry.list_artifacts(spark, str(tmp_path))
    assert registry.latest_artifact(listed).first()["name"] == "isolation_forest_1.joblib"
    assert {r["name"] for r in registry.matching_artifacts(listed).collect()} == {"isolation_forest_1.joblib", "lof_1.joblib"}


def _planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scores_are_written_before_the_quantile_reads_them(spark, monkeypatch):
    seen = []
    real = iforest.exact_quantiles
    monkeypatch.setattr(iforest, "exact_quantiles", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    rows = spark.range(300).selectExpr("id AS row_key", "cast(id % 17 AS float) AS a", "cast(id % 23 AS float) AS b")
    iforest.fit_forest(rows, "row_key", ["a", "b"], 5, 0.1, sub_sample=32)
    assert "Python" not in _planned(seen[0])  # every pass scored all rows again


def test_labels_are_written_before_they_are_described(spark, monkeypatch):
    slow = F.udf(lambda x: 1 if x % 5 else -1, "int")
    rows = spark.range(50).select(slow("id").alias("prediction"), *[(F.col("id") * 1.5).alias(c) for c in eval_queries._PROFILED])
    seen = []
    real = eval_queries.profile.describe
    monkeypatch.setattr(eval_queries, "explored", lambda *a, **k: rows)
    monkeypatch.setattr(eval_queries.profile, "describe", lambda df, *a, **k: seen.append(df) or real(df, *a, **k))
    assert eval_queries.describe_by_label(spark, "").count() == 8
    assert "Python" not in _planned(seen[0])
