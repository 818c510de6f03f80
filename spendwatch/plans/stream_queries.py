"""Streams over the event table and over JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spendwatch.operators import scoring
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import table
from spendwatch.plans.model_queries import SQL_SCORED, record_text, trained
from spendwatch.session import scratch_path
from spendwatch.streaming import streams

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a stream; the glob fits one file or a folder of files."""
    return streams.read_table_stream(spark, f"{folder}/events.parq*t", EVENT_SCHEMA)


@query("stream_score", SQL_SCORED + " SELECT row_key AS id_transaction, prediction, true AS success FROM p_scored")
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    detector, _ = trained(spark, folder)
    path = scratch_path(spark, "records")
    record_text(spark, folder, False).write.text(path)
    scored = scoring.score_json(streams.read_text_stream(spark, path), "value", detector, "id_transaction")
    return streams.drain(scored.select("id_transaction", "prediction", "success"), "stream_score")


@query(
    "stream_client_mean",
    """WITH p AS (SELECT event_id, user_id, value, ts, count(*) OVER w AS n, coalesce(avg(value) OVER w, 0) AS m FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT event_id AS id, user_id AS client_id, n AS prior_count, round(m, 9) AS prior_mean,
           CASE WHEN n = 0 THEN 0 ELSE round(value / (m + 1), 6) END AS amount_vs_prior
    FROM p WHERE epoch_ms(ts) < (SELECT epoch_ms(max(ts)) - 21600000 FROM events)""",
)
def stream_client_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Running means over six files in turn, each with rows up to five hours older than its slice of time.

    Rows leave once the watermark, six hours behind, has passed them.
    """
    events = table(spark, folder, "events")
    seconds = F.col("ts").cast("timestamp").cast("double")
    first, last = events.agg(F.min(seconds), F.max(seconds)).first()
    # an event is delivered up to five hours after its time, by its id
    delivered = seconds + F.col("event_id") % 6 * 3_600
    slice_ = F.floor((delivered - F.lit(first)) / F.lit((last - first + 18_001) / 6))
    path = scratch_path(spark, "deliveries")
    for number in range(6):
        events.filter(slice_ == number).coalesce(1).write.mode("append").parquet(path)
    source = streams.read_table_stream(spark, path, EVENT_SCHEMA, files=1)
    tracked = streams.running_client_mean(source, "user_id", "ts", "value", "event_id", "6 hours")
    out = streams.drain(tracked, "stream_client_mean")
    return out.select(
        F.col("key").alias("id"),
        F.col("client").alias("client_id"),
        "prior_count",
        F.round(F.coalesce("prior_mean", F.lit(0.0)), 9).alias("prior_mean"),
        F.round(F.coalesce("amount_vs_prior", F.lit(0.0)), 6).alias("amount_vs_prior"),
    )


@query(
    "stream_enrich",
    """SELECT event_id AS id, user_id AS client_id, value AS amount, c_mktsegment AS gender, c_acctbal AS yearly_income
       FROM events JOIN customer ON user_id = c_custkey""",
)
def stream_enrich(spark: SparkSession, folder: str) -> DataFrame:
    profiles = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("gender"), F.col("c_acctbal").alias("yearly_income")
    )
    joined = streams.enrich(event_stream(spark, folder), profiles, "user_id", "c_custkey")
    return streams.drain(
        joined.select(
            F.col("event_id").alias("id"), F.col("user_id").alias("client_id"), F.col("value").alias("amount"),
            "gender", "yearly_income",
        ),
        "stream_enrich",
    )


def _windows(spark: SparkSession, folder: str, window, keys: list[str], label: str) -> DataFrame:
    timed = streams.event_time(event_stream(spark, folder), "ts", "1 hour")
    closed = streams.drain(streams.activity(timed, window, keys, "value"), label)
    return closed.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        *keys,
        "n",
        F.round("total", 4).alias("total"),
        "largest",
    )


_CLOSED = "WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"


@query(
    "stream_tumbling",
    f"""SELECT * FROM (SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, user_id,
        count(*) AS n, round(sum(value), 4) AS total, max(value) AS largest FROM events GROUP BY 1, 2, 3) {_CLOSED}""",
)
def stream_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, F.window("ts", "1 day"), ["user_id"], "stream_tumbling")


@query(
    "stream_sliding",
    f"""SELECT * FROM (SELECT date_trunc('hour', ts) - o * INTERVAL 1 HOUR AS window_start,
        date_trunc('hour', ts) + (2 - o) * INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total,
        max(value) AS largest FROM events, range(2) r(o) GROUP BY 1, 2, 3) {_CLOSED}""",
)
def stream_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, F.window("ts", "2 hours", "1 hour"), ["event_type"], "stream_sliding")


@query(
    "stream_session",
    f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g)
    SELECT window_start, window_end, user_id, n, total, largest FROM (SELECT user_id, session, min(ts) AS window_start,
        max(ts) + INTERVAL 2 HOUR AS window_end, count(*) AS n, round(sum(value), 4) AS total, max(value) AS largest
        FROM s GROUP BY 1, 2) {_CLOSED}""",
)
def stream_session(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, F.session_window("ts", "2 hours"), ["user_id"], "stream_session")


@query("stream_dedup", "SELECT event_id AS id, user_id AS client_id, value AS amount FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every transaction is delivered twice and kept once."""
    timed = streams.event_time(event_stream(spark, folder), "ts", "1 hour")
    twice = timed.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    once = streams.drop_repeats(twice, "event_id")
    return streams.drain(
        once.select(F.col("event_id").alias("id"), F.col("user_id").alias("client_id"), F.col("value").alias("amount")),
        "stream_dedup",
    )


@query(
    "alert_rules",
    """SELECT * FROM (SELECT event_id AS id, concat_ws(',', CASE WHEN value > 150 THEN 'large' END,
        CASE WHEN (hour(ts) <= 6 OR hour(ts) >= 22) AND value > 60 THEN 'night' END,
        CASE WHEN event_type = 'error' THEN 'failed' END) AS rules FROM events) WHERE rules <> ''""",
)
def alert_rules(spark: SparkSession, folder: str) -> DataFrame:
    hour = F.hour("ts")
    rules = {
        "large": F.col("value") > 150,
        "night": ((hour <= 6) | (hour >= 22)) & (F.col("value") > 60),
        "failed": F.col("event_type") == "error",
    }
    raised = streams.alerts(event_stream(spark, folder), rules)
    return streams.drain(raised.select(F.col("event_id").alias("id"), "rules"), "alert_rules")


@query(
    "stream_quarantine",
    """SELECT CASE event_type WHEN 'error' THEN -1 ELSE event_id END AS id, event_type <> 'error' AND event_type <> 'signup' AS valid,
        CASE event_type WHEN 'error' THEN 'unreadable' WHEN 'signup' THEN 'missing mcc' ELSE '' END AS reason FROM events""",
)
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Records cut short or lacking a required column go to their own partition."""
    path = scratch_path(spark, "records")
    events = table(spark, folder, "events")
    whole = F.to_json(
        F.struct(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("client_id"),
            F.when(F.col("event_type") != "signup", F.col("user_id")).alias("mcc"),
        )
    )
    text = F.when(F.col("event_type") == "error", F.substring(whole, 1, 12)).otherwise(whole)
    events.select(text.alias("value")).write.text(path)
    schema = StructType().add("id", "long").add("client_id", "long").add("mcc", "long").add(scoring.CORRUPT, "string")
    checked = streams.validated(streams.read_text_stream(spark, path), "value", schema, ["client_id", "mcc"])
    out = streams.drain(checked.select("id", "reason", "valid"), "stream_quarantine", ("valid",))
    return out.select(
        F.coalesce("id", F.lit(-1)).alias("id"), "valid", F.coalesce("reason", F.lit("")).alias("reason")
    )
