"""Rank-one eigen updates and whitening against direct decompositions."""

from __future__ import annotations

import numpy as np
import pytest

from spendwatch.llm import whitening
from spendwatch.llm.secular import Scatter, updated
from spendwatch.llm.whitening import fit_whitening, whitened, whole_vectors

RNG = np.random.default_rng(11)
SHAPES = {
    "plain": np.floor(64 * RNG.normal(size=(900, 24)) * 0.15),
    "low rank": np.floor(64 * RNG.normal(size=(400, 5))) @ np.floor(4 * RNG.normal(size=(5, 24))),
    "binary": RNG.integers(0, 2, size=(300, 24)).astype(float),
    "unit": np.repeat(np.eye(24), 3, 0) * 1e6,
    "few": RNG.integers(-2, 3, size=(9, 24)).astype(float),
    "graded": RNG.normal(size=(500, 24)) * np.logspace(0, -9, 24),
    "constant": np.ones((30, 24)),
    "one dimension": RNG.normal(size=(50, 1)),
}


def _of(rows):
    scatter = Scatter(rows.shape[1])
    for row in rows:
        scatter.add(row)
    return scatter


def _close(scatter, rows):
    centred = rows - rows.mean(0)
    want = centred.T @ centred
    got = (scatter.vectors * scatter.values) @ scatter.vectors.T
    scale = max(np.abs(want).max(), 1e-300)
    assert np.abs(got - want).max() <= 1e-11 * scale
    assert np.abs(scatter.vectors.T @ scatter.vectors - np.eye(rows.shape[1])).max() < 1e-11


@pytest.mark.parametrize("name", SHAPES)
def test_rows_one_by_one(name):
    _close(_of(SHAPES[name]), SHAPES[name])


@pytest.mark.parametrize("name", SHAPES)
def test_parts_merged(name):
    rows = SHAPES[name]
    cut = len(rows) // 3
    one, two = _of(rows[:cut]), _of(rows[cut:])
    one.merge(two.count, two.mean, two.values, two.vectors)
    _close(one, rows)


def test_roots_interlace():
    values, vectors = np.sort(RNG.normal(size=12)), np.eye(12)
    v = RNG.normal(size=12)
    new, _ = updated(values, vectors, v)
    assert np.all(new >= values) and np.all(new[:-1] <= values[1:])
    assert np.allclose(new, np.linalg.eigvalsh(np.diag(values) + np.outer(v, v)), rtol=0, atol=1e-12)


def _direct(vectors, components=16):
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = (n * u - s) / n
    e, basis = np.linalg.eigh(c.T @ c / n)
    e, basis = e[::-1], basis[:, ::-1]
    k = min(components, int((e > 1e-13 * e.sum()).sum()))
    return n, ((n * x - s) ** 2).sum(1), ((n * x - s) / n) @ basis[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def _same(got, ids, vectors):
    n, deviation, white, explained = _direct(vectors)
    assert len(got) == white.size
    at = {i: k for k, i in enumerate(ids)}
    found = np.zeros_like(white)
    for r in got:
        found[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == deviation[at[r.vec_id]]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    signs = np.sign((found * white).sum(0))
    assert np.abs(found * signs - white).max() < 1e-7 * np.abs(white).max()


@pytest.mark.parametrize("parts", [1, 30])
def test_whitening_under_any_partitioning(spark, parts):
    vectors = (RNG.normal(size=(400, 20)) * np.linspace(0.2, 1, 20)).astype(np.float32)
    vectors[100:240] = vectors[7]  # a third of all rows are one vector
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    _same(whitened(frame.repartition(parts)).collect(), list(range(400)), vectors)


def test_leading_vectors_of_a_wide_basis(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FULL_BASIS", 10)
    monkeypatch.setattr(whitening, "BASIS", 20)
    vectors = (RNG.normal(size=(300, 40)) * np.logspace(1, -1, 40)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    _same(whitened(frame).collect(), list(range(300)), vectors)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    kept = [(1, [0.5, 1.0, 2.0]), (1, [0.5, 1.0, 2.0]), (None, [3.0, -1.0, 0.25]), (4, [0.0, 0.0, 7.5]), (5, [1.5, 2.0, 2.0])]
    odd = [(6, None), (7, []), (8, [1.0, None, 2.0]), (9, [nan, 0.0, 0.0]), (10, [inf, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in kept + odd], "vec_id int, embedding array<double>, x int, component string")
    got = whitened(frame).collect()
    assert len(got) == 5 * 3 and {r.vec_id for r in got} == {1, None, 4, 5} and {r.n for r in got} == {4}
    assert dict(whitened(frame).dtypes)["vec_id"] == "int"


def test_nothing_to_whiten(spark):
    one = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>")
    assert whitened(one).collect() == [] and whitened(one.limit(0)).collect() == []
    assert whitened(one).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_length_is_named(spark):
    frame = spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0, 3.0])], "vec_id long, embedding array<float>")
    with pytest.raises(Exception, match="entries, others have"):
        fit_whitening(whole_vectors(frame).select("x").distinct().coalesce(1))


def test_deviation_beyond_64_bits_is_null(spark):
    frame = spark.createDataFrame([(1, [1e16]), (2, [-1e16]), (3, [0.0])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in whitened(frame).collect()}
    assert got[1] is None and got[2] is None and got[3] == (3 * 1_000_000 - 3_000_000) ** 2
