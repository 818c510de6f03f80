"""Joins whose keys may be concentrated on a few values.

AQE splits a skewed join partition only when nothing downstream relies on the
join's partitioning, which two joins on the same client already do. Heavy keys
are therefore spread explicitly: a key counts as heavy when it holds more than
one row in ``HEAVY_SHARE``, so there are fewer than ``HEAVY_SHARE`` of them
whatever the table size, and their list can be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_SHARE = 1_000
SALTS = 64


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate lets it broadcast this side by itself."""
    spark = df.sparkSession
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):
        return False
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate <= spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def held(df: DataFrame, limit: int, what: str) -> DataFrame:
    """A per-group table with at most ``limit`` rows, computed once and broadcast.

    The optimizer sizes an aggregate by its input, so on a large table it would
    shuffle every row to meet a handful of groups.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}")
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def heavy_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys holding more than one row in ``HEAVY_SHARE``."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counted.agg(F.sum("_n")).scalar()
    return counted.filter(F.col("_n") * HEAVY_SHARE > total).select(*keys)


def spread_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False, salts: int = SALTS
) -> DataFrame:
    """``left`` joined to the per-key table ``right`` on same-named ``keys``.

    A ``right`` small enough to be broadcast needs no shuffle of ``left`` and
    is joined as is. Otherwise rows of heavy keys are dealt over ``salts``
    partitions by a hash of the whole row, and the few matching ``right`` rows
    are repeated for each.
    """
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in keys else F.col(f"`{c}`") for c in right.columns])

    def matches(left_side: DataFrame, right_side: DataFrame) -> list:
        pairs = [(left_side[k], right_side[f"_r_{k}"]) for k in keys]
        return [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs]

    gone = [f"_r_{k}" for k in keys]
    if fits_broadcast(right):
        return left.join(renamed, matches(left, renamed), how).drop(*gone)

    heavy = heavy_keys(left, keys)
    flags = F.broadcast(heavy.select(*[F.col(k).alias(f"_h_{k}") for k in keys], F.lit(True).alias("_heavy")))

    def flagged(df: DataFrame, names: Sequence[str]) -> DataFrame:
        same = [df[n].eqNullSafe(flags[f"_h_{k}"]) for n, k in zip(names, keys, strict=True)]
        return df.join(flags, same, "left").drop(*[f"_h_{k}" for k in keys])

    dealt = flagged(left, keys).withColumn(
        "_salt", F.when(F.col("_heavy"), F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")).otherwise(0)
    ).drop("_heavy")
    top = F.when(F.col("_heavy"), salts - 1).otherwise(0)
    repeated = flagged(renamed, gone).withColumn("_r_salt", F.explode(F.sequence(F.lit(0), top))).drop("_heavy")
    joined = dealt.join(repeated, [*matches(dealt, repeated), dealt["_salt"] == repeated["_r_salt"]], how)
    return joined.drop(*gone, "_salt", "_r_salt")
