import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendwatch.operators.features import add_time_features
from spendwatch.operators.scoring import CORRUPT
from spendwatch.streaming import streams

SCHEMA = "id long, client long, ts timestamp_ntz, amount double"


@pytest.fixture
def purchases(spark, tmp_path):
    """600 rows in time order, written as four files that arrive one per batch."""
    rows = spark.range(600).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 20).alias("client"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0, cast(id * 7 as int), 0)").alias("ts"),
        F.when(F.col("id") % 41 == 0, None).otherwise((F.col("id") * 37 % 101) + 0.5).alias("amount"),
    )
    folder = str(tmp_path / "in")
    for i in range(4):
        rows.filter((F.col("id") >= i * 150) & (F.col("id") < (i + 1) * 150)).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    return rows, source


@pytest.mark.parametrize("late", [0, 30])
def test_running_mean_sees_only_the_past_across_batches(spark, purchases, tmp_path, late):
    """In files that arrive in time order, and with rows up to ``late`` places behind in a later file."""
    rows, source = purchases
    if late:
        arrival = F.col("id") + F.col("id") % 7 * (late // 6)
        for i in range(5):
            rows.filter(F.floor(arrival / 130) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "mixed"))
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "mixed"))
    out = streams.drain(streams.running_client_mean(source, "client", "ts", "amount", "id", "4 hours"), "mean")
    got = {r["key"]: r for r in out.collect()}
    data = rows.orderBy("ts").toPandas()
    closed = data[data["ts"] < data["ts"].max() - np.timedelta64(4, "h")]
    assert set(got) == set(closed["id"]) and len(got) > 500
    for client, block in closed.groupby("client"):
        past = []
        for r in block.itertuples():
            assert got[r.id]["prior_count"] == len(past)
            if past:
                assert got[r.id]["prior_mean"] == pytest.approx(np.mean(past))
            else:
                assert got[r.id]["prior_mean"] is None
            if not np.isnan(r.amount):
                past.append(r.amount)


def test_windows_equal_batch_up_to_the_watermark(spark, purchases):
    rows, source = purchases
    window = F.window("ts", "6 hours")
    live = streams.drain(streams.activity(streams.event_time(source, "ts", "1 hour"), window, ["client"], "amount"), "window")
    batch = streams.activity(rows.withColumn("ts", F.col("ts").cast("timestamp")), window, ["client"], "amount")
    last = rows.agg(F.max("ts").cast("timestamp") - F.expr("interval 1 hour")).first()[0]
    closed = batch.filter(F.col("window_end") <= F.lit(last))
    assert sorted(map(tuple, live.collect())) == sorted(map(tuple, closed.collect())) and live.count() > 100


def test_late_rows_are_dropped(spark, tmp_path):
    """Rows are judged late by the watermark of the batch before, hence two batches ahead of the late one."""
    folder = str(tmp_path / "late")
    rows = "SELECT 1L id, 1L client, timestamp_ntz'2024-01-0{} 0{}:00:00' ts, {} amount"
    for day, hour, amount in [(3, 1, 1.0), (3, 2, 10.0), (1, 1, 5.0), (4, 1, 2.0), (5, 1, 3.0)]:
        spark.sql(rows.format(day, hour, f"cast({amount} as double)")).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    made = streams.activity(streams.event_time(source, "ts", "1 hour"), F.window("ts", "1 day"), ["client"], "amount")
    totals = {r["window_start"].day: r["total"] for r in streams.drain(made, "late").collect()}
    assert totals == {3: 11.0, 4: 2.0}


def test_repeats_are_dropped_across_batches(spark, purchases):
    rows, source = purchases
    again = streams.event_time(source, "ts", "1 hour").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    assert streams.drain(streams.drop_repeats(again, "id"), "repeats").count() == 600


def test_alerts_name_every_broken_rule(spark):
    rows = add_time_features(
        spark.createDataFrame([(1, 500.0, "2024-01-01 03:00:00"), (2, 1.0, "2024-01-01 12:00:00")], "id long, amount double, t string")
        .withColumn("date", F.col("t").cast("timestamp_ntz"))
    )
    raised = streams.alerts(rows, {"large": F.col("amount") > 100, "night": F.col("is_night_transaction")})
    assert [(r["id"], r["rules"]) for r in raised.collect()] == [(1, "large,night")]


def test_records_are_quarantined_with_reasons(spark):
    text = spark.createDataFrame([('{"id": 1, "mcc": 2}',), ('{"id": 2}',), ('{"id": 3, "m',), ('{"id": "x", "mcc": 1}',)], "value string")
    schema = StructType().add("id", "long").add("mcc", "long").add(CORRUPT, "string")
    got = [(r["valid"], r["reason"]) for r in streams.validated(text, "value", schema, ["id", "mcc"]).collect()]
    assert got == [(True, None), (False, "missing mcc"), (False, "unreadable"), (False, "unreadable")]


def test_enrichment_is_an_inner_join(spark, purchases):
    rows, source = purchases
    users = spark.createDataFrame([(1, "a"), (2, "b")], "uid long, gender string")
    out = streams.drain(streams.enrich(source, users, "client", "uid"), "enrich")
    assert out.count() == rows.filter("client IN (1, 2)").count() and "uid" not in out.columns


def test_a_client_advances_to_the_watermark_in_time_order():
    keys, times = np.array([4, 2, 9, 1]), np.array([3_000_000, 1_000_000, 8_000_000, 1_000_000])
    amounts = np.array([5.0, np.nan, 7.0, 2.0])
    rows, state, waiting, following = streams.advance(2, 10.0, keys, times, amounts, 5_000)
    assert [list(c) for c in (rows[0], rows[2], rows[3])] == [[1, 2, 4], [2, 3, 3], [10.0, 12.0, 12.0]]
    assert rows[1][0] == 2.0 and np.isnan(rows[1][1]) and rows[1][2] == 5.0
    assert state == (4, 17.0) and waiting == ([9], [8_000_000], [7.0]) and following == 8_000
    names = np.array(["b", "a"], dtype=object)
    assert streams.advance(0, 0.0, names, np.array([0, 0]), np.array([1.0, 2.0]), 1)[0][0].tolist() == ["a", "b"]
