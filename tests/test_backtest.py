"""Rolling-origin back-tests: what a fit may see, gaps, and skill where there is a pattern."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest

from spendwatch.operators import backtest

START = dt.date(2024, 1, 1)


def _frame(spark, values):
    return spark.createDataFrame([(START + dt.timedelta(k), float(v)) for k, v in enumerate(values) if v is not None], "day date, y double")


@pytest.mark.parametrize("parts", [1, 9])
def test_each_origin_is_fitted_on_the_days_before_it(spark, parts):
    rng = random.Random(4)
    values = [100 + k / 3 + 20 * (k % 7 == 5) + rng.gauss(0, 5) for k in range(200)]
    made = backtest.rolling_origin(_frame(spark, values).repartition(parts), "day", "y", 90, 30, 14).collect()
    assert len(made) == 3 * 14 + 14 and {r["ahead"] for r in made} == set(range(14))
    for r in made:
        o, k = (r["origin"] - START).days, (r["day"] - START).days
        t, y = np.arange(o), np.array(values[:o])
        slope, level = np.polyfit(t, y, 1)
        same = (np.arange(o) % 7) == k % 7
        assert abs(r["forecast"] - (level + slope * k + (y - level - slope * t)[same].mean())) < 1e-6
        assert r["actual"] == values[k] and r["naive"] == y[same][-1]


def test_forecasts_beat_the_last_same_weekday(spark):
    rng = random.Random(1)
    values = [50 + k / 5 + 30 * (k % 7 in (4, 5)) + rng.gauss(0, 6) for k in range(400)]
    found = backtest.errors(backtest.rolling_origin(_frame(spark, values), "day", "y", 120, 40, 28)).collect()
    assert len(found) == 7 and all(r["skill"] > 0 for r in found)


def test_missing_days_count_as_zero_and_short_series_have_no_rows(spark):
    values = [10.0 if k % 3 else None for k in range(1, 60)]
    rows = backtest.every_day(_frame(spark, values), "day", "y").collect()
    assert len(rows) == 59 - 1 + (values[-1] is not None) - (values[0] is None) and {r["y"] for r in rows} == {0.0, 10.0}
    assert backtest.rolling_origin(_frame(spark, values), "day", "y", 90, 30, 14).collect() == []
    assert backtest.rolling_origin(_frame(spark, []), "day", "y", 90, 30, 14).collect() == []
