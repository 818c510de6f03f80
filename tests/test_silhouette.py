import numpy as np
import pytest

from spendwatch.operators import quality
from test_quality import FEATURES, _clusters, _silhouette


def test_all_rows_are_scored(spark):
    rows, label, x = _clusters(spark, n=5_200)
    got = quality.silhouette_euclidean(rows.repartition(8), FEATURES, "c", "id").first()
    assert got["n_rows"] == 5_200


def test_blocks_add_up(spark, monkeypatch):
    monkeypatch.setattr(quality, "SILHOUETTE_BLOCK", 40)
    rows, label, x = _clusters(spark)
    label = np.where(np.arange(len(label)) == 7, 9, label)
    rows = spark.createDataFrame([(i, int(c), *map(float, v)) for i, (c, v) in enumerate(zip(label, x))], rows.schema)
    got = quality.silhouette_euclidean(rows, FEATURES, "c", "id").first()
    assert got["n_rows"] == 150 and got["score"] == pytest.approx(_silhouette(label, x, 1), abs=1e-4)
    assert quality.silhouette_euclidean(rows.limit(0), FEATURES, "c", "id").first()["n_rows"] == 0


def test_sums_by_matrix_products_hold_for_tight_clusters_far_away_and_for_copies():
    rng = np.random.default_rng(2)
    far = 1e5 + rng.normal(0, 1e-3, (70, 5))
    pts = np.concatenate([far, far[:30], rng.normal(0, 1, (90, 5))])
    x = np.concatenate([far[:20], rng.normal(0, 1, (20, 5))])
    got = quality.cluster_totals(x, pts, np.array([0, 50, 100]))
    away = np.sqrt(((x[:, None] - pts[None]) ** 2).sum(axis=2))
    want = np.add.reduceat(away, [0, 50, 100], axis=1)
    assert np.allclose(got, want, rtol=1e-9, atol=0)
