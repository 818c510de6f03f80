"""Cleaning and behavioural features of transactions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendwatch.functions import cleaning, timeparts
from spendwatch.operators.ingest import join_users
from spendwatch.operators.skew import spread_join

# The model's feature list, in order, and its version.
FEATURE_SCHEMA_VERSION = "v1.0"
FEATURE_NAMES = (
    "id_transaction",
    "client_id",
    "amount",
    "mcc",
    "current_age",
    "retirement_age",
    "birth_year",
    "birth_month",
    "latitude",
    "longitude",
    "per_capita_income",
    "yearly_income",
    "total_debt",
    "credit_score",
    "num_credit_cards",
    "transaction_hour",
    "day_of_week",
    "month",
    "is_weekend",
    "is_night_transaction",
    "amount_vs_avg",
    "use_chip_Online Transaction",
    "use_chip_Swipe Transaction",
    "gender_Male",
)

# Columns that never enter the matrix, and the encoded ones.
DROPPED_COLUMNS = (
    "timestamp",
    "user_id",
    "transaction_id",
    "date",
    "merchant_city",
    "merchant_state",
    "zip",
    "address",
    "card_id",
    "merchant_id",
    "errors",
)
TIME_FEATURES = ("transaction_hour", "day_of_week", "month", "is_weekend", "is_night_transaction")
ID_COLUMNS = ("id_transaction", "client_id")
CATEGORICAL_COLUMNS = ("use_chip", "gender")


def clean(df: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Money text to doubles and dates to timestamps, where those columns exist."""
    parsed: dict[str, Column] = {
        name: cleaning.parse_money(F.col(name)) for name in cleaning.MONEY_COLUMNS if name in df.columns
    }
    if "date" in df.columns:
        parsed["date"] = cleaning.parse_timestamp(F.col("date"), strict_dates)
    return df.withColumns(parsed)


def add_time_features(df: DataFrame, ts: str = "date") -> DataFrame:
    hour = timeparts.hour_of_day(F.col(ts))
    day = timeparts.day_of_week(F.col(ts))
    return df.withColumns(
        {
            "transaction_hour": hour,
            "day_of_week": day,
            "month": timeparts.month_of_year(F.col(ts)),
            "is_weekend": timeparts.is_weekend(day),
            "is_night_transaction": timeparts.is_night(hour),
        }
    )


def group_stats(df: DataFrame, keys: Iterable[str], stats: dict[str, Column]) -> DataFrame:
    """Attach per-group aggregates to every row.

    Aggregate then left-join instead of a window: the aggregate combines
    map-side, so a group holding a third of the rows costs one row per input
    partition, where a window would pull that whole group into one task; the
    join spreads such groups. Rows with a NULL key get NULL, as a data-frame
    group-transform gives.
    """
    keys = list(keys)
    known = df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    totals = known.groupBy(*keys).agg(*[expr.alias(name) for name, expr in stats.items()])
    return spread_join(df, totals, keys, "left").select(*[F.col(f"`{c}`") for c in df.columns], *stats)


def add_spending_ratio(df: DataFrame, client: str = "client_id", amount: str = "amount") -> DataFrame:
    """``amount_vs_avg``: amount over the client's mean amount plus one."""
    with_mean = group_stats(df, [client], {"client_mean": F.avg(amount)})
    ratio = F.try_divide(F.col(amount), F.col("client_mean") + 1)
    return with_mean.withColumn("amount_vs_avg", ratio).drop("client_mean")


def build_features(df: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Raw joined transactions to featured transactions."""
    return add_spending_ratio(add_time_features(clean(df, strict_dates)))


def join_and_build(transactions: DataFrame, users: DataFrame, strict_dates: bool = True) -> DataFrame:
    """As ``build_features(join_users(transactions, users))`` with one shuffle of the transactions.

    The client means are taken from the transactions alone (user rows only
    repeat or drop whole clients, which leaves a mean unchanged), attached to
    the per-client user rows, and both reach the transactions in one join.
    """
    tx = add_time_features(clean(transactions, strict_dates))
    means = tx.filter("client_id IS NOT NULL").groupBy("client_id").agg(F.avg("amount").alias("_client_mean"))
    profiles = clean(users, strict_dates).join(means.withColumnRenamed("client_id", "_mean_of"), F.col("id") == F.col("_mean_of"), "left")
    joined = join_users(tx, profiles.drop("_mean_of"))
    ratio = F.try_divide(F.col("amount"), F.col("_client_mean") + 1).alias("amount_vs_avg")
    raw = [c for c in joined.columns if c not in TIME_FEATURES and c != "_client_mean"]
    return joined.select(*[F.col(f"`{c}`") for c in (*raw, *TIME_FEATURES)], ratio)


def drop_columns(df: DataFrame, keep_ids: bool = False, extra: Iterable[str] = ()) -> DataFrame:
    """Remove columns that are not model inputs; absent names are ignored.

    ``keep_ids`` retains the row and client identifiers, which the published
    24-name schema contains although they carry no behaviour.
    """
    ids = () if keep_ids else ID_COLUMNS
    return df.drop(*DROPPED_COLUMNS, *ids, *extra)
