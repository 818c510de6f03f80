"""Spend aggregation, segments, supervised models and offers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendwatch.operators import classify, sampling, segments
from spendwatch.operators.dbscan import dbscan as run_dbscan
from spendwatch.operators.features import add_time_features, group_stats
from spendwatch.operators.sampling import dense_index, split_exact
from spendwatch.operators.skew import spread_join
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import mcc_code, sql_draw, table
from spendwatch.session import cut_lineage


def spend_by_period(orders: DataFrame, period: str) -> DataFrame:
    """Transactions, clients and spend per calendar period; cents are summed exactly."""
    spend = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    start = F.date_trunc(period, F.col("o_orderdate").cast("timestamp")).cast("date")
    return orders.groupBy(start.alias("period_start")).agg(
        F.count("*").alias("transactions"),
        F.count_distinct("o_custkey").alias("clients"),
        spend.alias("spend"),
        F.round(spend / F.count("*"), 8).alias("mean_spend"),
    )


def _spend_sql(period: str) -> str:
    return f"""SELECT CAST(date_trunc('{period}', o_orderdate) AS DATE) AS period_start, count(*) AS transactions,
        count(DISTINCT o_custkey) AS clients, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS spend,
        round(sum(o_totalprice::DECIMAL(18,2))::DOUBLE / count(*), 8) AS mean_spend
        FROM orders GROUP BY 1"""


@query("spend_daily", _spend_sql("day"))
def spend_daily(spark: SparkSession, folder: str) -> DataFrame:
    return spend_by_period(table(spark, folder, "orders"), "day")


@query("spend_weekly", _spend_sql("week"))
def spend_weekly(spark: SparkSession, folder: str) -> DataFrame:
    return spend_by_period(table(spark, folder, "orders"), "week")


@query("spend_monthly", _spend_sql("month"))
def spend_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return spend_by_period(table(spark, folder, "orders"), "month")


@query(
    "spend_by_category_region",
    """WITH s AS (SELECT o_orderpriority AS category, r_name AS region, count(*) AS transactions, sum(o_totalprice) AS spend
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
    SELECT category, region, transactions, round(spend, 2) AS spend,
           round(spend / sum(spend) OVER (PARTITION BY region), 6) AS share_of_region FROM s""",
)
def spend_by_category_region(spark: SparkSession, folder: str) -> DataFrame:
    places = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("region"))
    )
    joined = spread_join(table(spark, folder, "orders"), places, ["o_custkey"])
    totals = joined.groupBy(F.col("o_orderpriority").alias("category"), "region").agg(
        F.count("*").alias("transactions"), F.sum("o_totalprice").alias("spend")
    )
    # one row per category and region by now, so the window moves a handful of rows
    shared = totals.withColumn("region_spend", F.sum("spend").over(Window.partitionBy("region")))
    return shared.select(
        "category",
        "region",
        "transactions",
        F.round("spend", 2).alias("spend"),
        F.round(F.col("spend") / F.col("region_spend"), 6).alias("share_of_region"),
    )


def client_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Per client: orders, mean amount and balance."""
    totals = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("orders"), F.avg("o_totalprice").alias("mean_amount")
    )
    return table(spark, folder, "customer").join(totals, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_acctbal").alias("balance"),
        F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("mean_amount", F.lit(0.0)).alias("mean_amount"),
    )


@query("kmeans_segments", "SELECT count(*) AS clients, 5::BIGINT AS segments, 0::BIGINT AS misplaced FROM customer")
def kmeans_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Clients and segments, and how many clients lie nearer to another segment's centre than to their own."""
    made = segments.kmeans_segments(client_profiles(spark, folder), ["balance", "orders", "mean_amount"], k=5)
    return made.agg(
        F.count("*").alias("clients"), F.count_distinct("segment").alias("segments"), F.count_if(F.col("own_distance") > F.col("least_distance")).alias("misplaced")
    )


_EPS, _MIN_PTS = 0.25, 8


@query(
    "dbscan",
    f"""WITH RECURSIVE o AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
    p AS (SELECT c_custkey AS id, c_acctbal / 1000 AS x, coalesce(n, 0) * 0.5::DOUBLE AS y FROM customer LEFT JOIN o ON c_custkey = o_custkey),
    near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM p a, p b WHERE power(a.x - b.x, 2) + power(a.y - b.y, 2) <= {_EPS}::DOUBLE * {_EPS}::DOUBLE),
    core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= {_MIN_PTS}),
    link AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach(id, root) AS (SELECT id, id FROM core UNION SELECT l.b, r.root FROM reach r JOIN link l ON l.a = r.id),
    named AS MATERIALIZED (SELECT id, min(root) AS cluster FROM reach GROUP BY 1),
    border AS (SELECT a AS id, min(cluster) AS cluster FROM near JOIN named ON b = named.id GROUP BY 1)
    SELECT p.id, named.id IS NOT NULL AS is_core, coalesce(named.cluster, border.cluster, -1) AS cluster
    FROM p LEFT JOIN named ON p.id = named.id LEFT JOIN border ON p.id = border.id""",
)
def dbscan(spark: SparkSession, folder: str) -> DataFrame:
    points = client_profiles(spark, folder).select(
        "client_id", (F.col("balance") / 1000).alias("x"), (F.col("orders") * 0.5).alias("y")
    )
    return run_dbscan(points, "client_id", ["x", "y"], _EPS, _MIN_PTS)


_INPUTS = ["value", "mcc", "transaction_hour", "day_of_week", "client_mean"]


def supervised(spark: SparkSession, folder: str) -> DataFrame:
    """Events with numeric features and a stored split.

    The target is a rule on two of the features (weekend nights), so a working
    classifier separates it without error on the held-out part.
    """
    events = table(spark, folder, "events").withColumn("mcc", mcc_code(F.col("props")))
    known = group_stats(add_time_features(events, "ts"), ["user_id"], {"client_mean": F.avg("value")})
    risky = (F.col("is_night_transaction") & F.col("is_weekend")).alias("risky")
    return split_exact(known.select("event_id", *_INPUTS, risky), "event_id")


_JUDGED_SQL = f"""WITH d AS (SELECT (hour(ts) <= 6 OR hour(ts) >= 22) AND isodow(ts) >= 6 AS risky,
        row_number() OVER (ORDER BY {sql_draw(42, "event_id")}, event_id) <= ceil(count(*) OVER () * 0.15::DOUBLE) AS is_test FROM events)
    SELECT count_if(risky) AS true_positive, 0 AS false_positive, 0 AS false_negative, count_if(NOT risky) AS true_negative,
        1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, 1.0::DOUBLE AS auc FROM d WHERE is_test"""


def _judge(scored: DataFrame) -> DataFrame:
    """Confusion counts, rates and area under the curve on the held-out rows."""
    held_out = scored.filter("is_test")
    metrics = classify.confusion_metrics(held_out, "risky", "predicted")
    area = classify.auc(held_out, "risky", "probability_fraud").select("auc").scalar()
    return metrics.select(
        "true_positive", "false_positive", "false_negative", "true_negative", "precision", "recall", "f1", area.alias("auc")
    )


@query("rf_classify", _JUDGED_SQL)
def rf_classify(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut_lineage(supervised(spark, folder))
    params = dict(numTrees=20, maxDepth=6, featureSubsetStrategy="all")
    return _judge(segments.classify(rows, _INPUTS, "risky", "random_forest", **params))


@query("gbt_classify", _JUDGED_SQL)
def gbt_classify(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut_lineage(supervised(spark, folder))
    return _judge(segments.classify(rows, _INPUTS, "risky", "boosted_trees", maxIter=5, maxDepth=5))


@query(
    "volume_forecast",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS period_start, count(*) AS n FROM orders GROUP BY 1)
    SELECT d.period_start, d.n::DOUBLE AS transactions, CAST(isodow(d.period_start) - 1 AS INTEGER) AS weekday, CAST(month(d.period_start) AS INTEGER) AS month,
        coalesce(w.n, 0) AS week_before, coalesce(y.n, 0) AS day_before,
        row_number() OVER (ORDER BY d.period_start DESC) <= ceil(count(*) OVER () * 0.15::DOUBLE) AS is_test, true AS has_forecast
    FROM d LEFT JOIN d w ON w.period_start = d.period_start - 7 LEFT JOIN d y ON y.period_start = d.period_start - 1""",
)
def volume_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Lagged daily volume; the model learns from the earlier days only and forecasts all."""
    daily = spend_by_period(table(spark, folder, "orders"), "day").select("period_start", "transactions")
    days = F.col("period_start")
    earlier = daily.select(F.date_add(days, 7).alias("period_start"), F.col("transactions").alias("week_before"))
    before = daily.select(F.date_add(days, 1).alias("period_start"), F.col("transactions").alias("day_before"))
    rows = (
        daily.join(earlier, "period_start", "left")
        .join(before, "period_start", "left")
        .select(
            "period_start",
            F.col("transactions").cast("double").alias("transactions"),
            F.weekday(days).alias("weekday"),
            F.month(days).alias("month"),
            F.coalesce("week_before", F.lit(0)).alias("week_before"),
            F.coalesce("day_before", F.lit(0)).alias("day_before"),
        )
    )
    rows = cut_lineage(rows)  # one row per day
    held = sampling.test_size(rows.count(), 0.15)
    first_test = rows.orderBy(F.desc("period_start")).limit(held).agg(F.min("period_start")).scalar()
    split = rows.withColumn("is_test", F.coalesce(days >= first_test, F.lit(False)))
    inputs = ["weekday", "month", "week_before", "day_before"]
    made = segments.regress(split, inputs, "transactions", maxIter=10, maxDepth=3)
    return made.select(
        "period_start", "transactions", "weekday", "month", "week_before", "day_before", "is_test", F.col("forecast").isNotNull().alias("has_forecast")
    )


@query(
    "als_offers",
    """WITH e AS (SELECT user_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS mcc FROM events)
    SELECT user_id AS client_id, least(3, (SELECT count(DISTINCT mcc) FROM e)) AS offers, least(3, (SELECT count(DISTINCT mcc) FROM e)) AS different_codes,
           0 AS unknown_codes FROM e GROUP BY 1""",
)
def als_offers(spark: SparkSession, folder: str) -> DataFrame:
    """How many codes each client is offered from who buys what: three different ones that are in use."""
    uses = table(spark, folder, "events").select(F.col("user_id").alias("client_id"), mcc_code(F.col("props")).alias("mcc"))
    counted = cut_lineage(uses.groupBy("client_id", "mcc").agg(F.count("*").cast("float").alias("uses")))
    # the factorization wants small whole numbers for clients, whatever their ids
    numbered = cut_lineage(dense_index(counted.select("client_id").distinct(), "client_id", "als", "client_number"))
    known = counted.join(numbered, "client_id").select(F.col("client_number").cast("int").alias("client_number"), "mcc", "uses")
    made = segments.collaborative_offers(known, "client_number", "mcc", "uses", top=3, rank=5, maxIter=5)
    codes = counted.select("mcc").distinct().withColumn("in_use", F.lit(1))
    checked = made.join(codes, "mcc", "left").groupBy("client_number").agg(
        F.count("*").alias("offers"), F.count_distinct("mcc").alias("different_codes"), F.count_if(F.col("in_use").isNull()).alias("unknown_codes")
    )
    return numbered.join(checked, "client_number").select("client_id", "offers", "different_codes", "unknown_codes")


def _mix_sql(key: str) -> str:
    return f"""(SELECT {key}, list(coalesce(n, 0)::DOUBLE ORDER BY event_type) AS v FROM (SELECT DISTINCT {key} FROM e) CROSS JOIN (SELECT DISTINCT event_type FROM e)
        LEFT JOIN (SELECT {key}, event_type, count(*) AS n FROM e GROUP BY 1, 2) USING ({key}, event_type) GROUP BY 1)"""


@query(
    "content_offers",
    f"""WITH e AS (SELECT user_id AS client_id, event_type, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS mcc FROM events),
    c AS {_mix_sql("client_id")}, i AS {_mix_sql("mcc")},
    s AS (SELECT client_id, mcc, round(list_cosine_similarity(c.v, i.v), 9) AS score FROM c, i)
    SELECT client_id, row_number() OVER (PARTITION BY client_id ORDER BY score DESC, mcc)::INTEGER AS position, mcc, round(score, 6) AS score
    FROM s QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY score DESC, mcc) <= 3""",
)
def content_offers(spark: SparkSession, folder: str) -> DataFrame:
    """Three codes per client whose mix of event types is closest to the client's."""
    events = table(spark, folder, "events").select(
        F.col("user_id").alias("client_id"), "event_type", mcc_code(F.col("props")).alias("mcc")
    )
    kinds = [r["event_type"] for r in events.select("event_type").distinct().orderBy("event_type").collect()]  # a small dimension, all of it
    mix = F.array(*[F.count_if(F.col("event_type").eqNullSafe(k)).cast("double") for k in kinds]).alias("mix")
    made = segments.content_offers(
        events.groupBy("client_id").agg(mix), events.groupBy("mcc").agg(mix), "client_id", "mcc", "mix", top=3
    )
    return made.withColumn("score", F.round("score", 6))
