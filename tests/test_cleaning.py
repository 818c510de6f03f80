import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spendwatch.functions import cleaning, names, timeparts


@pytest.mark.parametrize(
    "text, value",
    [
        ("$1.50", 1.5), ("$-77.00", -77.0), ("-$5", -5.0), ("$$5", 5.0), ("1e3", 1000.0), (" 12 ", 12.0), (".5", 0.5), ("5.", 5.0),
        ("inf", float("inf")), ("1,234", None), ("", None), (None, None), ("1d", None), ("1f", None), ("0x10", None),
        ("1_000", None), ("True", None), ("nan", None), ("-", None),
    ],
)
def test_money_text(spark, text, value):
    row = spark.createDataFrame([(text,)], "t string").select(cleaning.parse_money(F.col("t")).alias("v")).first()
    assert row["v"] == value


def test_timestamps_strict_and_lenient(spark):
    rows = spark.createDataFrame([("2010-01-01 00:01:00",), ("no date",)], "t string")
    lenient = [r[0] for r in rows.select(cleaning.parse_timestamp(F.col("t"), strict=False)).collect()]
    assert lenient[0] is not None and lenient[1] is None
    with pytest.raises(PySparkException):
        rows.select(cleaning.parse_timestamp(F.col("t"))).collect()


def test_calendar_parts(spark):
    days = spark.createDataFrame([("2010-01-01 06:59:00",), ("2010-01-02 07:00:00",), ("2010-01-03 21:59:59",), ("2010-01-04 22:00:00",)], "t string")
    ts = F.col("t").cast("timestamp_ntz")
    day, hour = timeparts.day_of_week(ts), timeparts.hour_of_day(ts)
    rows = days.select(day.alias("d"), timeparts.is_weekend(day).alias("w"), timeparts.is_night(hour).alias("n")).collect()
    assert [r["d"] for r in rows] == [4, 5, 6, 0]
    assert [r["w"] for r in rows] == [False, True, True, False]
    assert [r["n"] for r in rows] == [True, False, False, True]


@pytest.mark.parametrize(
    "file, name",
    [
        ("isolation_forest_20250729_101500.joblib", "isolation_forest"),
        ("lof_i3_optimized_20250729_101500.joblib", "lof"),
        ("ocsvm_optimized.v2.joblib", "ocsvm"),
        ("kmeans_model_20250729_101500.pkl", "kmeans"),
        ("plain.pkl", "plain"),
    ],
)
def test_model_names(spark, file, name):
    assert spark.createDataFrame([(file,)], "f string").select(names.model_name(F.col("f"))).first()[0] == name
