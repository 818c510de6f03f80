"""Exact quantiles and ranks that never gather a whole column.

The built-in exact percentile keeps every distinct value of a group in one
aggregation buffer. That is right for groups of a checked size and is used for
them; larger groups are narrowed first: count values per equal-width interval,
keep the interval holding the wanted rank, repeat with that interval's own
minimum and maximum. A value repeated in a third of the rows ends the search
early, because its interval soon has equal minimum and maximum.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendwatch.functions.sqltext import ident, text

GATHER_BELOW = 1_000_000
INTERVALS = 4_096
MAX_TARGETS = 10_000


def long_form(df: DataFrame, columns: Iterable[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by…, column_name, value)`` without NULL or NaN values."""
    columns = list(columns)
    items = ", ".join(f"{text(c)}, cast({ident(c)} as double)" for c in columns)
    rows = df.selectExpr(*[ident(c) for c in by], f"stack({len(columns)}, {items}) AS (column_name, value)")
    return rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    gather_below: int = GATHER_BELOW,
    weight: str | None = None,
) -> DataFrame:
    """Rows ``(by…, column_name, prob, quantile)`` with linear interpolation.

    ``weight`` names a column of whole numbers saying how often a row counts.
    """
    rows = long_form(df, columns, [*by, weight] if weight else by)
    keys = [*by, "column_name"]
    copies = F.col(weight) if weight else F.lit(1)
    largest = df.groupBy(*by).count().agg(F.max("count")).first()[0] if by else df.count()
    if (largest or 0) <= gather_below:
        values = F.percentile("value", F.array(*[F.lit(float(p)) for p in probs]), copies)
        found = rows.groupBy(*keys).agg(values.alias("q"))
        return found.select(
            *keys, F.explode(F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]).alias("prob"), "q")).alias("z")
        ).select(*keys, F.col("z.prob").alias("prob"), F.col("z.q").alias("quantile"))

    # One group identifier per (by…, column_name), so narrowing has one key.
    tagged = rows.select(F.struct(*keys).alias("key"), "value", copies.alias("copies")).withColumn("group_id", F.to_json("key"))
    sizes = tagged.groupBy("group_id").agg(F.sum("copies").alias("n"), F.first("key").alias("key")).limit(MAX_TARGETS + 1).collect()
    if len(sizes) > MAX_TARGETS:
        raise ValueError("too many groups for exact quantiles; aggregate them first")
    wanted = {r["group_id"]: sorted({f((r["n"] - 1) * p) for p in probs for f in (math.floor, math.ceil)}) for r in sizes}
    at = _narrow(tagged.select("group_id", "value", "copies"), wanted, gather_below)
    out = []
    for r in sizes:
        for p in probs:
            h = (r["n"] - 1) * p
            low, high = at[r["group_id"], math.floor(h)], at[r["group_id"], math.ceil(h)]
            between = low if low == high else low + (high - low) * (h - math.floor(h))  # infinities included
            out.append((*r["key"], float(p), between))
    schema = rows.select(*keys).schema.add("prob", "double").add("quantile", "double")
    return df.sparkSession.createDataFrame(out, schema)


def value_at_ranks(values: DataFrame, ranks: Sequence[int], gather_below: int = GATHER_BELOW) -> dict[int, float]:
    """The values at 0-based ``ranks`` of a single ``value`` column."""
    tagged = values.select(F.lit("all").alias("group_id"), F.col("value").cast("double").alias("value"), F.lit(1).alias("copies"))
    found = _narrow(tagged, {"all": list(ranks)}, gather_below)
    return {rank: found["all", rank] for rank in ranks}


def _narrow(rows: DataFrame, wanted: dict[str, list[int]], gather_below: int) -> dict[tuple[str, int], float]:
    spark = rows.sparkSession
    targets = {(g, r): (None, None, 0, None) for g, ranks in wanted.items() for r in ranks}
    if len(targets) > MAX_TARGETS:
        raise ValueError("too many groups for exact quantiles; aggregate them first")
    done: dict[tuple[str, int], float] = {}
    bounds = {r["group_id"]: r for r in rows.groupBy("group_id").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("copies").alias("n")).collect()}
    targets = {(g, r): (bounds[g]["lo"], bounds[g]["hi"], 0, bounds[g]["n"]) for g, r in targets}

    while True:
        for key, (lo, hi, _, _) in list(targets.items()):
            if lo == hi:
                done[key] = lo
                del targets[key]
        if not targets:
            return done
        table = spark.createDataFrame(
            [(g, r, lo, hi, before) for (g, r), (lo, hi, before, _) in targets.items()],
            "group_id string, rank bigint, lo double, hi double, before bigint",
        )
        # The targets are at most MAX_TARGETS rows, so broadcasting is safe.
        inside = rows.join(F.broadcast(table), "group_id").filter("value >= lo AND value <= hi")
        if max(n for _, _, _, n in targets.values()) <= gather_below:
            counted = inside.groupBy("group_id", "rank", "before", "value").agg(F.sum("copies").alias("count"))
            order = Window.partitionBy("group_id", "rank").orderBy("value")
            reached = counted.withColumn("upto", F.col("before") + F.sum("count").over(order))
            hits = reached.filter("upto > rank").groupBy("group_id", "rank").agg(F.min("value").alias("value"))
            done.update({(h["group_id"], h["rank"]): h["value"] for h in hits.collect()})
            return done
        # infinities have slots of their own; halves keep the width of a finite range finite
        low, high = _finite(F.col("lo")), _finite(F.col("hi"))
        share = (F.col("value") / 2 - low / 2) / (high / 2 - low / 2)
        slot = (
            F.when(F.col("value") == math.inf, INTERVALS)
            .when(F.col("value") == -math.inf, -1)
            .when(low == high, 0)
            .otherwise(F.least(F.floor(share * INTERVALS), F.lit(INTERVALS - 1)))
        )
        counts = inside.groupBy("group_id", "rank", slot.alias("slot")).agg(
            F.sum("copies").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        running = Window.partitionBy("group_id", "rank").orderBy("slot")
        upto = counts.withColumn("upto", F.sum("n").over(running))
        placed = upto.join(F.broadcast(table.select("group_id", "rank", "before")), ["group_id", "rank"])
        chosen = placed.filter("before + upto > rank AND before + upto - n <= rank").collect()
        for c in chosen:
            key = (c["group_id"], c["rank"])
            targets[key] = (c["lo"], c["hi"], c["before"] + c["upto"] - c["n"], c["n"])


def _finite(edge):
    """A range's edge with infinity moved to the largest finite number."""
    most = sys.float_info.max
    return F.greatest(F.least(edge, F.lit(most)), F.lit(-most))


def running_totals(df: DataFrame, order: str, totals: Sequence[str], buckets: int = 256) -> DataFrame:
    """Adds ``{name}_before``: sums over rows with a smaller ``order`` value.

    ``order`` must be unique (aggregate to it first). Rows are placed in
    buckets of about equal size by approximate quantiles; each bucket is ranked
    on its own and shifted by the totals of the buckets before it.
    """
    from pyspark.ml.feature import Bucketizer

    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    edges = df.agg(F.percentile_approx(order, probs, F.lit(buckets * 10))).first()[0] or []
    splits = [-math.inf, *sorted(set(edges)), math.inf]
    placed = Bucketizer(splits=splits, inputCol=order, outputCol="_bucket").transform(df)

    sums = [F.sum(t).alias(f"_{t}") for t in totals]
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_bucket").agg(*sums).select(
        "_bucket", *[F.coalesce(F.sum(f"_{t}").over(earlier), F.lit(0)).alias(f"_{t}_off") for t in totals]
    )
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(F.broadcast(offsets), "_bucket")
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(F.sum(t).over(within), F.lit(0)) + F.col(f"_{t}_off")).alias(f"{t}_before")
            for t in totals
        ],
    )
