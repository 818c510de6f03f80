import numpy as np
import pytest
from pyspark.sql import functions as F

from spendwatch.operators.classify import auc
from spendwatch.operators.quantiles import exact_quantiles, running_totals, value_at_ranks

PROBS = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]


def _skewed(spark, n=20_000):
    """A third of the rows share one value, the rest is heavy-tailed, some are missing."""
    value = F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 50 == 1, None).otherwise(F.exp(F.col("id") % 1_000 / 100.0))
    return spark.range(n).select("id", (F.col("id") % 2).alias("g"), value.alias("v"), (F.col("id") * 0.5).alias("w"))


@pytest.mark.parametrize("gather_below", [10**9, 50])
def test_quantiles_match_numpy(spark, gather_below):
    rows = _skewed(spark)
    got = {
        (r["g"], r["column_name"], r["prob"]): r["quantile"]
        for r in exact_quantiles(rows, ["v", "w"], PROBS, ["g"], gather_below).collect()
    }
    data = rows.toPandas()
    for g in (0, 1):
        for c in ("v", "w"):
            want = np.percentile(data.loc[data.g == g, c].dropna(), [100 * p for p in PROBS])
            assert np.allclose([got[g, c, p] for p in PROBS], want, rtol=1e-12)


@pytest.mark.parametrize("gather_below", [10**9, 5])
def test_weighted_quantiles_count_copies(spark, gather_below):
    rows = spark.range(200).select((F.col("id") * 1.5).alias("v"), (F.col("id") % 4).alias("w"))
    data = rows.toPandas()
    want = np.percentile(np.repeat(data.v, data.w), [100 * p for p in PROBS])
    got = exact_quantiles(rows.filter("w > 0"), ["v"], PROBS, (), gather_below, "w").orderBy("prob").collect()
    assert np.allclose([r["quantile"] for r in got], want)


def test_values_at_ranks_by_narrowing(spark):
    rows = _skewed(spark, 5_000).select(F.col("v").alias("value")).filter("value IS NOT NULL")
    ordered = np.sort([r["value"] for r in rows.collect()])
    ranks = [0, 1, 1_700, len(ordered) - 1]
    assert value_at_ranks(rows, ranks, 10) == {r: ordered[r] for r in ranks}


def test_running_totals(spark):
    rows = spark.range(1_000).select((F.col("id") * 1.5).alias("s"), (F.col("id") % 7).alias("n"))
    got = running_totals(rows, "s", ["n"], buckets=16).orderBy("s").collect()
    total = 0
    for r in got:
        assert r["n_before"] == total
        total += r["n"]


def test_auc_with_ties_matches_pair_counting(spark):
    rows = spark.range(400).select((F.col("id") % 3 == 0).alias("a"), (F.pmod(F.col("id") * 37, F.lit(23)) / 3.0).alias("s"))
    data = rows.toPandas()
    pos, neg = data.s[data.a].to_numpy(), data.s[~data.a].to_numpy()
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert auc(rows, "a", "s", buckets=8).first()["auc"] == pytest.approx(want)


def test_infinite_values_end(spark):
    """Ranges that reach from minus to plus infinity, and nearly as far, still shrink."""
    import math

    values = [float(n) for n in range(2_000)] + [math.inf] * 3 + [-math.inf] * 2 + [1.7e308, -1.7e308]
    rows = spark.createDataFrame([(v,) for v in values], "value double")
    found = value_at_ranks(rows, [0, 1, 2, 3, 1_000, 2_002, 2_003, 2_004, 2_006], gather_below=100)
    assert [found[r] for r in sorted(found)] == [sorted(values)[r] for r in sorted(found)]
