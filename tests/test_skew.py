import pytest
from pyspark.sql import functions as F

from spendwatch.operators import features, ingest
from spendwatch.operators.skew import heavy_keys, spread_join


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _rows(spark, n=6_000):
    """A third of the rows on client 1, a tenth without a client."""
    client = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 2_000 + 10)
    return spark.range(n).select("id", client.cast("long").alias("client_id"), (F.col("id") % 97 + 0.25).alias("amount"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_plain_join(spark, no_broadcast, how, null_safe):
    left = _rows(spark)
    right = spark.range(1_500).select(F.when(F.col("id") > 0, F.col("id")).alias("client_id"), (F.col("id") * 2).alias("v"))
    right = right.unionByName(spark.createDataFrame([(1, -5)], right.schema))
    made = spread_join(left, right, ["client_id"], how, null_safe)
    assert "_salt" in _plan(made)
    theirs = right.withColumnRenamed("client_id", "k")
    same = left["client_id"].eqNullSafe(theirs["k"]) if null_safe else left["client_id"] == theirs["k"]
    plain = left.join(theirs, same, how).drop("k")
    assert made.columns == plain.columns
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_heavy_keys_are_few(spark):
    assert {r["client_id"] for r in heavy_keys(_rows(spark), ["client_id"]).collect()} == {1, None}


def test_small_side_is_not_salted(spark):
    right = spark.range(5).select(F.col("id").alias("client_id"), (F.col("id") * 2).alias("v"))
    assert "_salt" not in _plan(spread_join(_rows(spark), right, ["client_id"]))


def test_joint_features_equal_the_two_steps(spark, no_broadcast):
    tx = _rows(spark).select(
        "id", "client_id", F.concat(F.lit("$"), F.col("amount").cast("string")).alias("amount"),
        F.lit("2024-01-06 23:00:00").alias("date"), F.lit(1).alias("mcc"),
    )
    users = spark.range(1_200).select("id", F.lit("$10").alias("yearly_income")).unionByName(
        spark.createDataFrame([(1, "$20")], "id long, yearly_income string")
    )
    slow = features.build_features(ingest.join_users(tx, users))
    fast = features.join_and_build(tx, users)
    assert fast.columns == slow.columns
    key = lambda r: repr(r)
    assert sorted(map(tuple, fast.withColumn("amount_vs_avg", F.round("amount_vs_avg", 9)).collect()), key=key) == sorted(
        map(tuple, slow.withColumn("amount_vs_avg", F.round("amount_vs_avg", 9)).collect()), key=key
    )
