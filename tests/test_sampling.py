import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendwatch.functions.hashing import unit_draw, unit_hash
from spendwatch.operators import sampling


def test_draw_is_the_same_in_and_outside_spark(spark):
    rows = spark.range(5).select("id", unit_hash("7:x", "id").alias("u")).collect()
    assert [r["u"] for r in rows] == [unit_draw("7:x", r["id"]) for r in rows]


@pytest.mark.parametrize("n", [150, 250])
def test_half_even_sample_size(spark, n):
    assert sampling.sample_exact(spark.range(n), "id", fraction=0.01).count() == 2


def test_split_sizes(spark):
    parts = sampling.split_exact(spark.range(101), "id")
    assert {r["is_test"]: r["count"] for r in parts.groupBy("is_test").count().collect()} == {True: 16, False: 85}


def test_same_rows_under_any_partitioning(spark):
    rows = spark.range(5_000)
    first = {r["id"] for r in sampling.sample_exact(rows.repartition(2), "id", n=100).collect()}
    second = {r["id"] for r in sampling.sample_exact(rows.repartition(16), "id", n=100).collect()}
    assert first == second and len(first) == 100


def test_narrowing_matches_a_global_sort(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RANK_LOCALLY_BELOW", 3)
    monkeypatch.setattr(sampling, "INTERVALS", 8)
    rows = spark.range(2_000)
    got = {r["id"] for r in sampling.sample_exact(rows, "id", n=777, seed="s").collect()}
    assert got == set(sorted(range(2_000), key=lambda i: unit_draw("s", i))[:777])


def test_repeated_keys_are_reported(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RANK_LOCALLY_BELOW", 5)
    same = spark.range(100).select(F.lit(1).alias("id"))
    with pytest.raises(ValueError, match="identify"):
        sampling.sample_exact(same, "id", n=10)


def test_stratified_with_hot_and_null_strata(spark):
    rows = spark.range(1_000).select(
        "id", F.when(F.col("id") < 900, "hot").when(F.col("id") < 990, "cold").alias("s")
    )
    parts = sampling.split_stratified(rows, "id", "s").filter("is_test").groupBy("s").count().collect()
    sizes = {r["s"]: r["count"] for r in parts}
    assert sum(sizes.values()) == 150
    assert (sizes["hot"], sizes["cold"]) in {(135, 14), (135, 13)} and sizes[None] in (1, 2)


@given(st.dictionaries(st.text(min_size=1, max_size=3), st.integers(1, 1000), min_size=1, max_size=6), st.floats(0, 1))
@settings(max_examples=100, deadline=None)
def test_proportional_sizes_add_up(rows, share):
    total = sampling.test_size(sum(rows.values()), share)
    sizes = sampling.proportional_sizes(rows, total)
    assert sum(sizes.values()) == total
    assert all(abs(sizes[s] - rows[s] * total / sum(rows.values())) < 1 for s in rows)


def test_dense_index_is_a_permutation(spark):
    got = [r["row_index"] for r in sampling.dense_index(spark.range(3_000), "id", "i").collect()]
    assert sorted(got) == list(range(3_000))


@pytest.mark.parametrize("crowded", [64, 3])
def test_rows_at_positions_are_those_of_the_index(spark, monkeypatch, crowded):
    monkeypatch.setattr(sampling, "CROWDED", crowded)
    rows = spark.range(20_000).select("id", (F.col("id") * 2).alias("value"))
    places = [0, 1, 5, 5, 17, 4_000, 19_998, 19_999, 20_000, 10**12]
    wanted = {r["row_index"]: r["id"] for r in sampling.dense_index(rows, "id", "p").collect() if r["row_index"] in places}
    for parts in (1, 13):
        got = sampling.rows_at_positions(rows.repartition(parts), "id", "p", spark.createDataFrame([(p,) for p in places], "row_index bigint"))
        assert {r["row_index"]: r["id"] for r in got.collect()} == wanted and got.count() == len(wanted) == 7
    none = sampling.rows_at_positions(rows.limit(0), "id", "p", spark.createDataFrame([(1,)], "row_index bigint"))
    assert none.collect() == [] and none.columns == ["id", "value", "row_index"]


def test_folds_cover_all_rows(spark):
    sizes = [r["count"] for r in sampling.folds(spark.range(5_000), "id").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 5_000 and min(sizes) > 900
