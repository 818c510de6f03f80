import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.operators import lof, neighbors
from spendwatch.operators.components import connected_components
from spendwatch.operators.dbscan import dbscan
from spendwatch.operators.neighbors import distinct_points, nearest
from spendwatch.operators.sampling import split_exact
from spendwatch.session import cut_lineage


def _points(seed, n, d=2, copies=0):
    rng = np.random.default_rng(seed)
    x = np.round(np.concatenate([rng.normal(0, 1, (n // 2, d)), rng.normal(6, 0.3, (n - n // 2, d))]), 3)
    if copies:
        x[:copies] = x[0]
    return x


def _frame(spark, x, groups=None):
    groups = groups if groups is not None else np.zeros(len(x), dtype=int)
    return spark.createDataFrame(
        [(i, int(g), [float(v) for v in row]) for i, (g, row) in enumerate(zip(groups, x))], "id bigint, grp bigint, x array<double>"
    )


@pytest.mark.parametrize("block_rows, cell_rows", [(2_048, 2_048), (16, 20)])
def test_neighbours_match_brute_force(spark, block_rows, cell_rows):
    x = _points(3, 240, d=3)
    groups = np.arange(240) % 2
    refs = distinct_points(_frame(spark, x, groups))
    queries = refs.select(F.col("rid").alias("qid"), "grp", "x")
    got = {r["qid"]: r["near"] for r in nearest(queries, refs, 5, True, block_rows, cell_rows).collect()}
    assert len(got) == 240
    for i in range(240):
        away = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        others = [j for j in np.lexsort((np.arange(240), away)) if j != i and groups[j] == groups[i]][:5]
        assert [n["rid"] for n in got[i]] == others
        assert np.allclose([n["d"] for n in got[i]], away[others])


def _lof_by_hand(x, k):
    n = len(x)
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    near = [[j for j in np.lexsort((np.arange(n), away[i])) if j != i][:k] for i in range(n)]
    reach = np.array([away[i][near[i][-1]] for i in range(n)])
    density = np.array([1 / (np.maximum(reach[near[i]], away[i][near[i]]).mean() + 1e-10) for i in range(n)])
    return np.array([density[near[i]].mean() / density[i] for i in range(n)])


@pytest.mark.parametrize("copies", [0, 60])
def test_factors_match_brute_force_even_with_copies(spark, copies):
    x = _points(5, 180, copies=copies)
    points = _frame(spark, x)
    model = lof.fit_lof(points, k=10, block_rows=32, cell_rows=40)
    got = {r["id"]: r for r in lof.fitted_labels(points, model).collect()}
    want = _lof_by_hand(x, 10)
    assert np.allclose([got[i]["factor"] for i in range(180)], want)
    cut = np.percentile(-want, 10)
    assert [got[i]["prediction"] for i in range(180)] == [1 if -w >= cut or np.isclose(-w, cut, rtol=1e-13) else -1 for w in want]


def test_new_rows_are_scored_against_their_group(spark):
    x = _points(7, 120)
    model = lof.fit_lof(_frame(spark, x, (x[:, 0] > 3).astype(int)), k=8)
    new = spark.createDataFrame(
        [(1, 0, [0.1, 0.1]), (2, 1, [6.0, 6.0]), (3, 1, [9.0, 2.0]), (4, 5, [0.0, 0.0])], "id bigint, grp bigint, x array<double>"
    )
    got = {r["id"]: r["prediction"] for r in lof.score_lof(new, model).collect()}
    assert got == {1: 1, 2: 1, 3: -1, 4: 1}


def test_nearest_centroid_and_clusters(spark):
    x = _points(9, 60)
    rows = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id int, a double, b double")
    centers = lof.fit_clusters(rows, ["a", "b"], k=2)
    near = rows.select("id", "a", lof.nearest_centroid(rows, ["a", "b"], centers).alias("c")).collect()
    sides = {r["c"] for r in near if r["a"] > 3}, {r["c"] for r in near if r["a"] <= 3}
    assert len(sides[0]) == len(sides[1]) == 1 and sides[0] != sides[1]


def test_components_of_a_long_chain_and_islands(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    edges = spark.createDataFrame(chain + [(900, 901), (902, 901)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(301), 900, 901, 902, 999]], "node long")
    got = {r["node"]: r["component"] for r in connected_components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(301))
    assert (got[900], got[901], got[902], got[999]) == (900, 900, 900, 999)


def _dbscan_by_hand(x, eps, min_pts):
    near = (((x[:, None] - x[None]) ** 2).sum(axis=2)) <= eps * eps
    core = near.sum(axis=1) >= min_pts
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] < 0:
            todo, label[i] = [i], i
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core):
                    if label[j] < 0:
                        label[j] = i
                        todo.append(j)
    for i in np.flatnonzero(~core):
        touching = label[near[i] & core]
        label[i] = touching.min() if len(touching) else -1
    return core, label


@pytest.mark.parametrize("measure_below, copies", [(10**7, 0), (0, 0), (10**7, 70)])
def test_dbscan_matches_brute_force(spark, measure_below, copies):
    x = _points(11, 210, copies=copies)
    rows = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    got = {r["id"]: r for r in dbscan(rows, "id", ["a", "b"], 0.35, 5, measure_below).collect()}
    core, label = _dbscan_by_hand(x, 0.35, 5)
    assert [got[i]["is_core"] for i in range(210)] == list(core)
    assert [got[i]["cluster"] for i in range(210)] == list(label)


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_a_query_is_sent_once_to_each_area_and_no_neighbour_is_lost(spark, monkeypatch, shift):
    written = []

    def counted(df, cut=neighbors.cut_lineage):
        out = cut(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(neighbors, "cut_lineage", counted)
    x = np.round(np.random.default_rng(11).normal(0, 1, (400, 16)), 6) + shift  # so many dimensions that no cell is ruled out
    refs = distinct_points(_frame(spark, x))
    queries = refs.select(F.col("rid").alias("qid"), "grp", "x")
    got = {r["qid"]: r["near"] for r in nearest(queries, refs, 5, True, 64, 10).collect()}
    assert max(written) <= 400  # a row for each query and cell before
    for i in range(400):
        away = neighbors.distances(x[i : i + 1], x)[0]
        others = [j for j in np.lexsort((np.arange(400), away)) if j != i][:5]
        assert [n["rid"] for n in got[i]] == others
        assert [n["d"] for n in got[i]] == away[others].tolist()


def test_points_with_missing_or_endless_entries(spark):
    x = _points(13, 60, d=2)
    frame = _frame(spark, x).unionByName(
        spark.createDataFrame([(100, 0, [None, 1.0]), (101, 0, [float("inf"), 0.0])], "id bigint, grp bigint, x array<double>")
    )
    refs = distinct_points(frame)
    queries = refs.select(F.col("rid").alias("qid"), "grp", "x")
    got = {r["qid"]: [n["rid"] for n in r["near"]] for r in nearest(queries, refs, 3, True).collect()}
    assert got[100] == []
    for i in range(60):
        away = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        assert got[i] == [j for j in np.lexsort((np.arange(60), away)) if j != i][:3]


@pytest.mark.parametrize("turn_bytes", [1 << 26, 150 * 40])
@pytest.mark.parametrize("d, cell_rows, copies", [(16, 10, 0), (16, 10**9, 60), (2, 12, 60)])
def test_points_are_dealt_out_a_few_times_and_no_neighbour_is_lost(spark, monkeypatch, d, cell_rows, copies, turn_bytes):
    dealt, kept = [], type(spark.range(0)).repartition

    def counted(df, *args):
        dealt.append(df.count())
        return kept(df, *args)

    monkeypatch.setattr(type(spark.range(0)), "repartition", counted)
    monkeypatch.setattr(neighbors, "TURN_BYTES", turn_bytes, raising=False)
    x = np.round(np.random.default_rng(17).normal(0, 1, (400, d)), 3)
    x[:copies] = x[0]
    refs = cut_lineage(distinct_points(_frame(spark, x)))
    held = _scratch(spark)
    lists = nearest(refs.select(F.col("rid").alias("qid"), "grp", "x"), refs, 5, True, 20, cell_rows)
    got = {r["qid"]: r["near"] for r in lists.collect()}
    assert max(dealt) <= 3 * 400  # in one cell, a copy for each block of 50 before
    assert all(p in "".join(lists.inputFiles()) for p in _scratch(spark) - held)  # only what is returned stays
    assert len(got) == (401 - copies if copies else 400)
    for i in got:
        away = neighbors.distances(x[i : i + 1], x)[0]
        want = {}
        for j in [j for j in np.lexsort((np.arange(400), away)) if j != i][:5]:
            want[0 if j < copies else j] = want.get(0 if j < copies else j, 0) + 1
        assert {n["rid"]: n["w"] for n in got[i]} == want
        assert [n["d"] for n in got[i]] == sorted(away[j] for j in want)


def _scratch(spark):
    return set(os.listdir(spark.conf.get("spark.checkpoint.dir")))


def test_pivots_are_drawn_from_what_a_split_leaves(spark):
    rows = split_exact(_frame(spark, _points(19, 600)), "id").filter("NOT is_test")
    assert len(neighbors._pivots(distinct_points(rows), 20, 42)[0][1]) > 10  # one before: the split's test rows had all small draws


def test_shuffle_files_go_with_the_writes(spark):
    def files():
        kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum("shuffle_" in kept.apply(i).getName() for i in range(kept.size()))

    points = _frame(spark, _points(23, 200))
    before = files()
    model = lof.fit_lof(points, k=8, block_rows=32, cell_rows=40)
    lof.score_lof(points, model, 32, 40)
    assert files() <= before + 20


def test_32_bit_features_stay_so_and_give_the_same_factors(spark):
    x = _points(29, 120, d=3).astype(np.float32)
    rows = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id bigint, a float, b float, c float")
    points = lof.to_points(rows, "id", ["a", "b", "c"])
    assert dict(points.dtypes)["x"] == "array<float>"
    assert dict(lof.to_points(rows.withColumn("a", F.col("a").cast("int")), "id", ["a", "b"]).dtypes)["x"] == "array<double>"
    got = {r["id"]: r["factor"] for r in lof.fitted_labels(points, lof.fit_lof(points, 10, 0.1, 32, 40)).collect()}
    assert np.allclose([got[i] for i in range(120)], _lof_by_hand(x.astype(float), 10), rtol=1e-12)
