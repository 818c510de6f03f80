"""Back-tests of the daily volume forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.operators import backtest
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import table

HISTORY, STEP, HORIZON = 365, 91, 28

_SQL = f"""WITH given AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*)::DOUBLE AS y FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
    span AS (SELECT min(day) AS a, max(day) AS b FROM given),
    days AS MATERIALIZED (SELECT c.day, coalesce(y, 0) AS y, (c.day - a)::DOUBLE AS t, isodow(c.day) AS weekday FROM
        (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM span) c LEFT JOIN given ON given.day = c.day, span),
    origins AS (SELECT CAST(unnest(generate_series(a + {HISTORY}, b, INTERVAL {STEP} DAY)) AS DATE) AS origin FROM span),
    past AS (SELECT origin, day, y, t, weekday FROM days JOIN origins ON day < origin),
    trend AS MATERIALIZED (SELECT origin, regr_slope(y, t) AS slope, regr_intercept(y, t) AS level FROM past GROUP BY 1),
    season AS MATERIALIZED (SELECT origin, weekday, avg(y - (level + slope * t)) AS effect, max_by(y, day) AS naive FROM past JOIN trend USING (origin) GROUP BY 1, 2),
    made AS MATERIALIZED (SELECT o.origin, day, CAST(day - o.origin AS INTEGER) AS ahead, y AS actual, level + slope * t + coalesce(effect, 0) AS forecast, naive
        FROM days JOIN origins o ON day >= o.origin AND day < o.origin + {HORIZON} JOIN trend ON trend.origin = o.origin
        LEFT JOIN season ON season.origin = o.origin AND season.weekday = days.weekday)"""


def _made(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("one", F.lit(1))
    return backtest.rolling_origin(orders, "o_orderdate", "one", HISTORY, STEP, HORIZON)


@query("forecast_backtest", f"{_SQL} SELECT origin, day, ahead, actual, round(forecast, 6) AS forecast, naive FROM made")
def forecast_backtest(spark: SparkSession, folder: str) -> DataFrame:
    return _made(spark, folder).withColumn("forecast", F.round("forecast", 6))


@query(
    "forecast_error",
    f"""{_SQL} SELECT origin, count(*) AS n_days, round(avg(abs(actual - forecast)), 6) AS mae, round(avg(abs(actual - naive)), 6) AS naive_mae,
        round(1 - avg(abs(actual - forecast)) / nullif(avg(abs(actual - naive)), 0), 6) AS skill FROM made GROUP BY 1""",
)
def forecast_error(spark: SparkSession, folder: str) -> DataFrame:
    return backtest.errors(_made(spark, folder)).select("origin", "n_days", *[F.round(c, 6).alias(c) for c in ("mae", "naive_mae", "skill")])
