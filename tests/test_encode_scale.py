import pytest
from pyspark.sql import functions as F

from spendwatch.operators import encode, scale


def test_one_hot_baseline_null_and_unseen(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "v string, id int")
    found = encode.fit_categories(rows, ["v", "absent"])
    assert found == {"v": ["a", "b", "c"]}
    out = encode.one_hot(rows, found)
    assert out.columns == ["id", "v_b", "v_c"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 1)]
    unseen = spark.createDataFrame([("other", 9)], "v string, id int")
    assert tuple(encode.one_hot(unseen, found).first()) == (9, 0, 0)


def test_quotes_in_category_values(spark):
    rows = spark.createDataFrame([("it's",), ("a`b",), ("x\\y",)], "v string")
    out = encode.one_hot(rows, encode.fit_categories(rows, ["v"]), drop_first=False)
    assert set(out.columns) == {"v_it's", "v_a`b", "v_x\\y"}
    assert sum(sum(r) for r in out.collect()) == 3


def test_too_many_categories_are_refused(spark):
    rows = spark.range(20).select(F.col("id").cast("string").alias("v"))
    with pytest.raises(ValueError, match="more than 10"):
        encode.fit_categories(rows, ["v"], limit=10)


def test_align_order_missing_and_null(spark):
    rows = spark.createDataFrame([(True, None, "x")], "flag boolean, amount double, extra string")
    out = encode.align(rows, ["amount", "credit_score", "flag"])
    assert out.dtypes == [("amount", "float"), ("credit_score", "float"), ("flag", "float")]
    assert tuple(out.first()) == (0.0, 0.0, 1.0)


def test_scaler_population_deviation_and_constant(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    fitted = scale.fit_scaler(rows, ["a", "b"])
    assert fitted.means == (2.0, 5.0) and fitted.deviations == (1.0, 1.0)
    assert [tuple(r) for r in scale.apply_scaler(rows, fitted).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert scale.apply_scaler(rows, None) is rows


def test_downcast_bounds(spark):
    rows = spark.createDataFrame([(2147483646, 2147483647, 1.5)], "a long, b long, c double")
    assert encode.downcast(rows).dtypes == [("a", "int"), ("b", "bigint"), ("c", "float")]
