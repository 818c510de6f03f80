"""Rolling-origin back-tests of a daily series.

For each origin a trend with weekday effects is fitted on all days before it
and forecasts the days that follow; the last day of the same weekday before the
origin is the forecast to beat. All origins are fitted in one grouped
aggregation: a day is repeated once for each origin that it precedes, so the
work is days times origins, both counted in calendar time and not in
transactions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def every_day(series: DataFrame, day: str, value: str) -> DataFrame:
    """``day, y``: the series with a row of 0 for each missing day between its first and last."""
    given = series.filter(F.col(day).isNotNull()).groupBy(F.col(day).cast("date").alias("day")).agg(F.sum(F.col(value).cast("double")).alias("y"))
    calendar = given.agg(F.min("day").alias("a"), F.max("day").alias("b")).filter("a IS NOT NULL")
    days = calendar.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.join(given, "day", "left").select("day", F.coalesce("y", F.lit(0.0)).alias("y"))


def rolling_origin(series: DataFrame, day: str, value: str, history: int, step: int, horizon: int) -> DataFrame:
    """``origin, day, ahead, actual, forecast, naive`` of every forecast day.

    The first origin has ``history`` days before it; the next ones follow every
    ``step`` days. A series without so many days has no rows.
    """
    days = every_day(series, day, value)
    first, last = days.agg(F.min("day"), F.max("day")).first()
    empty = "origin date, day date, ahead int, actual double, forecast double, naive double"
    if first is None or (last - first).days < history:
        return series.sparkSession.createDataFrame([], empty)
    origins = F.expr(f"sequence(date_add(DATE'{first}', {history}), DATE'{last}', INTERVAL {step} DAY)")
    rows = days.withColumn("t", F.datediff("day", F.lit(first)).cast("double")).withColumn("weekday", F.weekday("day")).withColumn("_o", origins)
    before = rows.select("day", "y", "t", "weekday", F.explode(F.filter("_o", lambda o: o > F.col("day"))).alias("origin"))
    ahead = rows.select("day", "y", "t", "weekday", F.explode(F.filter("_o", lambda o: (o <= F.col("day")) & (F.col("day") < F.date_add(o, horizon)))).alias("origin"))

    trend = before.groupBy("origin").agg(F.regr_slope("y", "t").alias("slope"), F.regr_intercept("y", "t").alias("level"))
    line = F.col("level") + F.col("slope") * F.col("t")
    season = before.join(trend, "origin").groupBy("origin", "weekday").agg(F.avg(F.col("y") - line).alias("effect"), F.max_by("y", "day").alias("naive"))
    made = ahead.join(trend, "origin").join(season, ["origin", "weekday"], "left")
    return made.select(
        "origin", "day", F.datediff("day", "origin").alias("ahead"), F.col("y").alias("actual"),
        (line + F.coalesce("effect", F.lit(0.0))).alias("forecast"), "naive",
    )


def errors(forecasts: DataFrame) -> DataFrame:
    """Per origin: days, mean absolute error of the forecast and of the last same weekday, and their skill."""
    by = forecasts.groupBy("origin").agg(
        F.count("*").alias("n_days"), F.avg(F.abs(F.col("actual") - F.col("forecast"))).alias("mae"), F.avg(F.abs(F.col("actual") - F.col("naive"))).alias("naive_mae")
    )
    return by.withColumn("skill", 1 - F.try_divide("mae", "naive_mae"))
