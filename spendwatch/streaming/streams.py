"""Stream sources, stateful features, windows, alerts and quarantine.

Scoring needs nothing here: :func:`spendwatch.operators.scoring.score` and
``score_json`` work on a streaming DataFrame as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from spendwatch.operators.scoring import CORRUPT, parse_records
from spendwatch.session import scratch_path

# Bytes read per micro-batch; a single larger file still comes whole.
BATCH_BYTES = str(256 << 20)


def read_table_stream(spark: SparkSession, pattern: str, schema: StructType | str, files: int | None = None) -> DataFrame:
    """Parquet files matching a glob, in micro-batches of about ``BATCH_BYTES``, or of a number of files."""
    limit = ("maxBytesPerTrigger", BATCH_BYTES) if files is None else ("maxFilesPerTrigger", str(files))
    return spark.readStream.schema(schema).option(*limit).parquet(pattern)


def read_text_stream(spark: SparkSession, path: str) -> DataFrame:
    """Text records, one per line."""
    return spark.readStream.option("maxBytesPerTrigger", BATCH_BYTES).text(path)


def event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Zone-free times become instants, which watermarks require."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def drain(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Process everything available, append to Parquet, and read the result back."""
    spark = df.sparkSession
    root = scratch_path(spark, label)
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
    )
    writer.partitionBy(*partition_by).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{root}/out")


def advance(count: int, total: float, keys: np.ndarray, times: np.ndarray, amounts: np.ndarray, watermark_ms: int) -> tuple:
    """One client's rows (times in microseconds) that the watermark has passed, and what stays.

    Returns the passed rows in time order as keys, amounts, earlier counts and
    earlier sums; the new count and sum; the waiting rows; and the time in
    milliseconds of the first of them.
    """
    passed = times // 1000 < watermark_ms
    later = ~passed
    leaving, at, block = keys[passed], times[passed], amounts[passed]
    order = np.lexsort((pd.factorize(leaving, sort=True)[0] if leaving.dtype == object else leaving, at))
    leaving, block = leaving[order], block[order]
    known = ~np.isnan(block)
    spent = np.where(known, block, 0.0)
    seen = (np.cumsum(known) - known + count).astype(np.int64)
    summed = np.cumsum(spent) - spent + total
    held = (keys[later].tolist(), times[later].tolist(), [None if a != a else a for a in amounts[later].tolist()])
    next_ms = int(times[later].min() // 1000) if later.any() else None
    return (leaving, block, seen, summed), (int(count + known.sum()), float(total + spent.sum())), held, next_ms


def running_client_mean(df: DataFrame, client: str, ts: str, amount: str, key: str, delay: str) -> DataFrame:
    """Mean of the client's *earlier* amounts, and the spending ratio to it.

    Earlier is by event time. Rows wait in the client's state until the
    watermark, ``delay`` behind the newest time seen, has passed them, and then
    leave in time order, so the result does not depend on how rows are spread
    over micro-batches. Otherwise the state is a count and a sum. A client's
    first amount has ``prior_count`` 0 and no mean. Rows without a time are
    left out; rows later than the watermark are dropped by it.
    """
    rows = event_time(
        df.select(F.col(key).alias("key"), F.col(client).alias("client"), F.col(ts).alias("ts"), F.col(amount).cast("double").alias("amount")), "ts", delay
    ).filter("ts IS NOT NULL")

    def update(
        client_key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        # Plain arrays, since most clients have few rows in a batch and a table costs more than they do.
        count, total, *waiting = state.get if state.exists else (0, 0.0, [], [], [])
        keys, times, amounts = waiting[0], np.array(waiting[1], np.int64), np.array(waiting[2], np.float64)
        if state.hasTimedOut:
            keys = pd.Series(list(keys)).to_numpy()
        else:
            new = pd.concat(list(batches))
            micros = new["ts"].astype("datetime64[us, UTC]" if new["ts"].dt.tz is not None else "datetime64[us]").astype("int64")
            arrived = new["key"].to_numpy()
            keys = np.concatenate((pd.Series(list(keys)).to_numpy(), arrived)) if len(keys) else arrived
            times = np.concatenate((times, micros.to_numpy()))
            amounts = np.concatenate((amounts, new["amount"].to_numpy(np.float64)))
        (leaving, block, seen, summed), total_spent, held, next_ms = advance(count, total, keys, times, amounts, state.getCurrentWatermarkMs())
        state.update((*total_spent, *held))
        if next_ms is not None:
            state.setTimeoutTimestamp(next_ms)
        yield pd.DataFrame(
            {"key": leaving, "client": [client_key[0]] * len(block), "amount": block,
             "prior_count": seen, "prior_total": summed}
        )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = f"key {kinds['key']}, client {kinds['client']}, amount double, prior_count bigint, prior_total double"
    held = f"count bigint, total double, keys array<{kinds['key']}>, times array<bigint>, amounts array<double>"
    tracked = rows.groupBy("client").applyInPandasWithState(update, out, held, "append", GroupStateTimeout.EventTimeTimeout)
    mean = F.when(F.col("prior_count") > 0, F.col("prior_total") / F.col("prior_count"))
    return tracked.withColumn("prior_mean", mean).withColumn(
        "amount_vs_prior", F.try_divide(F.col("amount"), F.col("prior_mean") + 1)
    )


def enrich(stream: DataFrame, users: DataFrame, client: str, user_key: str) -> DataFrame:
    """Stream-static inner join with client profiles."""
    return stream.join(users, stream[client] == users[user_key]).drop(users[user_key])


def activity(df: DataFrame, window: Column, keys: list[str], amount: str) -> DataFrame:
    """Counts and spend per key and window; windows close behind the watermark."""
    return df.groupBy(window.alias("w"), *keys).agg(
        F.count("*").alias("n"), F.sum(amount).alias("total"), F.max(amount).alias("largest")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n", "total", "largest")


def drop_repeats(df: DataFrame, key: str) -> DataFrame:
    """Suppress repeated transactions for as long as the watermark remembers them."""
    return df.dropDuplicatesWithinWatermark([key])


def alerts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break at least one rule, with the names of all rules broken."""
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]))
    return df.withColumn("rules", F.array_join(broken, ",")).filter(F.col("rules") != "")


def validated(text: DataFrame, column: str, schema: StructType, required: list[str]) -> DataFrame:
    """Parsed records with ``valid`` and, for the rest, the reason to quarantine them.

    Writing this partitioned by ``valid`` separates both outputs in one pass.
    """
    parsed = parse_records(text, column, schema)
    unreadable = F.col(CORRUPT).isNotNull()
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    reason = F.when(unreadable, F.lit("unreadable")).when(
        F.size(absent) > 0, F.concat(F.lit("missing "), F.array_join(absent, ","))
    )
    return parsed.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())
