import json

import pytest
from pyspark.sql import functions as F

from spendwatch.operators import features, ingest
from spendwatch.sources import files


def _tables(spark):
    tx = spark.createDataFrame([(1, 10, 5), (2, 11, 5), (3, None, 5), (4, 12, 5)], "id long, client_id long, mcc int")
    users = spark.createDataFrame([(10, "a"), (10, "b"), (11, "c"), (None, "d")], "id long, gender string")
    return tx, users


def test_join_suffixes_fan_out_and_null_keys(spark):
    tx, users = _tables(spark)
    plain = ingest.join_users(tx, users)
    assert plain.columns == ["id_transaction", "client_id", "mcc", "gender"]
    assert sorted(r["id_transaction"] for r in plain.collect()) == [1, 1, 2]
    paired = ingest.join_users(tx, users, null_safe=True)
    assert sorted(r["id_transaction"] for r in paired.collect()) == [1, 1, 2, 3]


def test_load_raw_round_trip_and_checks(spark, tmp_path):
    (tmp_path / "transactions_data.csv").write_text("id,client_id,mcc,amount\n1,10,5411,$3.50\n")
    (tmp_path / "users_data.csv").write_text("id,gender\n10,Female\n")
    tx_schema, user_schema = "id long, client_id long, mcc int, amount string", "id long, gender string"
    with pytest.raises(FileNotFoundError, match="mcc_codes.json"):
        files.load_raw(spark, str(tmp_path), tx_schema, user_schema)
    (tmp_path / "mcc_codes.json").write_text(json.dumps({"5411": "Grocery", "1": "Other"}, indent=2))
    tx, users, mcc = files.load_raw(spark, str(tmp_path), tx_schema, user_schema)
    joined = ingest.add_mcc_description(features.clean(ingest.join_users(tx, users)), mcc).first()
    assert (joined["amount"], joined["gender"], joined["mcc_description"]) == (3.5, "Female", "Grocery")
    with pytest.raises(ValueError, match="client_id"):
        files.load_raw(spark, str(tmp_path), "id long, amount string", user_schema)


def test_labels(spark):
    pairs = spark.createDataFrame([("7", 1), ("8", 0), ("x9", 1), ("10", 1)], "key string, value int")
    labels = files.label_map(pairs)
    ids = spark.createDataFrame([(7,), (7,), (11,)], "id long")
    assert tuple(ingest.label_coverage(ids, labels).first()) == (2, 2, 1)
    assert [r["id"] for r in ingest.unmatched_labels(labels, ids).collect()] == [10]
    none = labels.filter("id < 0")
    assert tuple(ingest.label_coverage(ids, none).first()) == (0, 2, 0)


def test_spending_ratio_edges(spark):
    rows = spark.createDataFrame(
        [(1, 10, 2.0), (2, 10, 4.0), (3, None, 9.0), (4, 11, -1.0), (5, 12, None)], "id long, client_id long, amount double"
    )
    got = {r["id"]: r["amount_vs_avg"] for r in features.add_spending_ratio(rows).collect()}
    assert got == {1: 0.5, 2: 1.0, 3: None, 4: None, 5: None}


def test_hot_client_keeps_every_row(spark):
    rows = spark.range(30_000).select(
        "id", F.when(F.col("id") < 12_000, 1).otherwise(F.col("id")).alias("client_id"), F.lit(2.0).alias("amount")
    )
    out = features.add_spending_ratio(rows)
    assert out.count() == 30_000
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
