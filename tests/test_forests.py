"""Many forests at once: the same trees as alone, out-of-fold scores, any partitioning."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.operators import forests, iforest
from spendwatch.operators.sampling import folds

FEATURES = ("a", "b", "c")


@pytest.fixture(scope="module")
def rows(spark):
    made = spark.range(2_000).select("id", *[(F.rand(k) * 10).alias(n) for k, n in enumerate(FEATURES)])
    return spark.createDataFrame(made.collect(), "id bigint, a double, b double, c double")


def test_models_grow_as_they_would_alone(spark, rows):
    specs = [forests.Spec(6, 32), forests.Spec(4, 64, bootstrap=True, max_features=0.7), forests.Spec(5, 16, seed=7)]
    nodes, used = forests.grow_all(rows.repartition(5), "id", FEATURES, specs)
    got = forests.forests_of(nodes, FEATURES, specs, used)
    for spec, forest in zip(specs[:2], got):
        alone, n = iforest.fit_nodes(rows, "id", FEATURES, spec.trees, spec.max_features, spec.bootstrap, spec.sub_sample, spec.seed)
        assert sorted(map(tuple, alone.collect())) == sorted(forest.nodes) and n == forest.sub_sample
    scores = forests.with_all_scores(rows, got).collect()
    each = [{r["id"]: r["score"] for r in iforest.with_scores(rows, f).collect()} for f in got]
    assert all(np.allclose(r["scores"], [e[r["id"]] for e in each], atol=1e-12) for r in scores)


def test_a_fold_is_judged_by_the_forest_that_never_saw_it(rows):
    marked = folds(rows, "id", 4)
    one = {r["id"]: (r["fold"], r["score"], r["prediction"]) for r in forests.cross_validated(marked.repartition(3), "id", FEATURES, 4, 0.1, trees=8, sub_sample=32).collect()}
    two = {r["id"]: (r["fold"], r["score"], r["prediction"]) for r in forests.cross_validated(marked.repartition(17), "id", FEATURES, 4, 0.1, trees=8, sub_sample=32).collect()}
    assert one == two and len(one) == 2_000
    # dropping the fold's own rows changes nothing: none of them was drawn
    specs = [forests.Spec(8, 32, seed="42:2", leave_out=2)]
    without, _ = forests.grow_all(marked.filter("fold <> 2"), "id", FEATURES, specs, 42, "fold")
    with_it, used = forests.grow_all(marked, "id", FEATURES, specs, 42, "fold")
    assert sorted(map(tuple, without.collect())) == sorted(map(tuple, with_it.collect()))
    forest = forests.forests_of(with_it, FEATURES, specs, used)[0]
    scored = iforest.with_scores(marked.filter("fold = 2"), forest).collect()
    assert all(abs(one[r["id"]][1] - r["score"]) < 1e-12 for r in scored)
    flagged = [v[2] for v in one.values()].count(-1) / len(one)
    assert 0.05 < flagged < 0.16


def test_too_many_trees_are_refused(rows):
    with pytest.raises(ValueError, match="trees"):
        forests.grow_all(rows, "id", FEATURES, [forests.Spec(forests.MOST_TREES + 1)])
