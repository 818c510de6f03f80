"""Scans, sinks, joins, cleaning, features, encoding, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.functions import cleaning
from spendwatch.operators import encode, features, ingest, sampling, scale, scoring
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import (
    SQL_FEATURED,
    SQL_PRIMARY,
    featured,
    primary,
    raw_transactions,
    sql_draw,
    table,
)
from spendwatch.session import scratch_path
from spendwatch.sources import files


@query(
    "scan_csv",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation_id,
              c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
)
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scan_csv")
    table(spark, folder, "customer").write.option("header", True).csv(path)
    rows = files.read_csv(
        spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    )
    return rows.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_id"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )


@query(
    "scan_json_map",
    """SELECT 'k' AS key, regexp_extract(props, '[0-9]+') AS value, count(*) AS n
       FROM events GROUP BY 2""",
)
def scan_json_map(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "scan_json_map")
    table(spark, folder, "events").select("props").write.text(path)
    pairs = files.json_map_rows(spark.read.text(path), F.col("value"))
    return pairs.groupBy("key", "value").agg(F.count("*").alias("n"))


@query(
    "scan_parquet",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity
       FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01' GROUP BY ALL""",
)
def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    early = table(spark, folder, "lineitem").filter(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    return early.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


@query(
    "sink_roundtrip",
    "SELECT o_orderkey AS id, o_totalprice AS amount, o_orderdate AS date, o_orderpriority AS priority FROM orders",
)
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sink_roundtrip")
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("priority"),
    )
    files.write_parquet(rows, path)
    return spark.read.parquet(path)


@query("label_map", "SELECT event_id AS id FROM events WHERE event_type = 'error'")
def label_map(spark: SparkSession, folder: str) -> DataFrame:
    """Label objects hold numeric and foreign keys; only numeric ones flagged 1 count."""
    events = table(spark, folder, "events")
    text = events.select(
        F.to_json(
            F.create_map(
                F.col("event_id").cast("string"),
                (F.col("event_type") == "error").cast("int"),
                F.concat(F.lit("tx-"), F.col("event_id").cast("string")),
                F.lit(1),
            )
        ).alias("text")
    )
    return files.label_map(files.json_map_rows(text, F.col("text"), "int"))


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    """Flagged ids, half of which lie outside the known transactions."""
    errors = table(spark, folder, "events").filter("event_type = 'error'")
    return errors.select((F.col("event_id") * 2).alias("id"))


def _ids(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(F.col("event_id").alias("id"))


SQL_LABELS = "labels_ AS (SELECT DISTINCT event_id * 2 AS id FROM events WHERE event_type = 'error')"


@query(
    "label_coverage",
    f"""WITH {SQL_LABELS}
    SELECT (SELECT count(*) FROM labels_) AS label_ids,
           (SELECT count(DISTINCT event_id) FROM events) AS transaction_ids,
           (SELECT count(*) FROM labels_ WHERE id IN (SELECT event_id FROM events)) AS matching_ids""",
)
def label_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.label_coverage(_ids(spark, folder), _labels(spark, folder))


@query(
    "label_unmatched",
    f"WITH {SQL_LABELS} SELECT id FROM labels_ WHERE id NOT IN (SELECT event_id FROM events)",
)
def label_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.unmatched_labels(_labels(spark, folder), _ids(spark, folder))


@query(
    "id_intersect",
    f"WITH {SQL_LABELS} SELECT id FROM labels_ INTERSECT SELECT event_id FROM events",
)
def id_intersect(spark: SparkSession, folder: str) -> DataFrame:
    return _labels(spark, folder).intersect(_ids(spark, folder))


@query(
    "union_batches",
    """SELECT event_type AS batch, count(*) AS n, CAST(sum(CASE WHEN value >= 10 THEN 1 ELSE -1 END) AS BIGINT) AS net
       FROM events GROUP BY 1""",
)
def union_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Per-batch predictions concatenated by name."""
    events = table(spark, folder, "events")
    label = F.when(F.col("value") >= 10, 1).otherwise(-1).alias("prediction")
    # two batches that together hold every row, whatever its kind
    high = F.coalesce(F.col("value") >= 10, F.lit(False))
    first, rest = (events.filter(part).select(F.col("event_type").alias("batch"), label) for part in (high, ~high))
    whole = first.unionByName(rest)
    return whole.groupBy("batch").agg(F.count("*").alias("n"), F.sum("prediction").alias("net"))


@query(
    "ingest_join",
    f"""WITH {SQL_PRIMARY} SELECT id_transaction, client_id, date, amount, use_chip, mcc,
        yearly_income, gender, nation_id FROM primary_rows""",
)
def ingest_join(spark: SparkSession, folder: str) -> DataFrame:
    return features.clean(primary(spark, folder))


@query(
    "ingest_join_nullsafe",
    """WITH t AS (SELECT event_id AS id_transaction,
                        CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS client_id FROM events),
            u AS (SELECT CASE WHEN c_custkey = 0 THEN NULL ELSE c_custkey END AS id, c_mktsegment AS gender FROM customer)
       SELECT id_transaction, client_id, gender FROM t JOIN u ON t.client_id IS NOT DISTINCT FROM u.id""",
)
def ingest_join_nullsafe(spark: SparkSession, folder: str) -> DataFrame:
    tx = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("client_id"),
    )
    users = table(spark, folder, "customer").select(
        F.when(F.col("c_custkey") != 0, F.col("c_custkey")).alias("id"), F.col("c_mktsegment").alias("gender")
    )
    return ingest.join_users(tx, users, null_safe=True)


@query(
    "mcc_enrich",
    """SELECT e.event_id AS id, CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) AS mcc, p.p_type AS mcc_description
       FROM events e LEFT JOIN part p ON CAST(regexp_extract(e.props, '[0-9]+') AS INTEGER) = p.p_partkey""",
)
def mcc_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """Codes are looked up in a map stored as JSON text, one object per category."""
    part = table(spark, folder, "part")
    text = part.select(F.to_json(F.create_map(F.col("p_partkey").cast("string"), F.col("p_type"))).alias("text"))
    codes = files.json_map_rows(text, F.col("text")).select(
        F.col("key").cast("int").alias("mcc"), F.col("value").alias("mcc_description")
    )
    return ingest.add_mcc_description(raw_transactions(spark, folder).select("id", "mcc"), codes)


_VARIANTS = {
    "view": lambda v: F.concat(F.lit("$"), v),
    "click": lambda v: F.concat(F.lit("  -$"), v, F.lit(" ")),
    "purchase": lambda v: F.concat(v, F.lit("d")),
    "signup": lambda v: F.concat(F.lit("1,"), v),
}


@query(
    "clean_money",
    """SELECT event_id AS id, CASE event_type WHEN 'view' THEN value WHEN 'click' THEN -value
              WHEN 'error' THEN 1000.0 END AS amount FROM events""",
)
def clean_money(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    text = F.lit("$1e3")
    for kind, make in _VARIANTS.items():
        text = F.when(F.col("event_type") == kind, make(F.col("value").cast("decimal(18,2)").cast("string"))).otherwise(text)
    return events.select(F.col("event_id").alias("id"), cleaning.parse_money(text).alias("amount"))


@query(
    "parse_ts",
    """SELECT event_id AS id, ts AS strict_ts, CASE WHEN event_type <> 'error' THEN ts END AS lenient_ts FROM events""",
)
def parse_ts(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type", F.col("ts").cast("string").alias("text"))
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("day "), F.col("text"))).otherwise(F.col("text"))
    return events.select(
        F.col("event_id").alias("id"),
        cleaning.parse_timestamp(F.col("text")).alias("strict_ts"),
        cleaning.parse_timestamp(broken, strict=False).alias("lenient_ts"),
    )


@query(
    "features",
    f"""WITH {SQL_FEATURED}
    SELECT id_transaction, client_id, amount, mcc, use_chip, gender, yearly_income, transaction_hour, day_of_week,
           month, is_weekend, is_night_transaction, round(amount_vs_avg, 6) AS amount_vs_avg FROM featured""",
)
def build(spark: SparkSession, folder: str) -> DataFrame:
    return featured(spark, folder).select(
        "id_transaction", "client_id", "amount", "mcc", "use_chip", "gender", "yearly_income", "transaction_hour",
        "day_of_week", "month", "is_weekend", "is_night_transaction", F.round("amount_vs_avg", 6).alias("amount_vs_avg"),
    )


@query(
    "client_mean",
    """SELECT event_id AS id, user_id AS client_id, round(avg(value) OVER (PARTITION BY user_id), 8) AS client_mean
       FROM events""",
)
def client_mean(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("client_id"), "value"
    )
    out = features.group_stats(rows, ["client_id"], {"client_mean": F.avg("value")})
    return out.select("id", "client_id", F.round("client_mean", 8).alias("client_mean"))


@query(
    "client_mean_window",
    """SELECT o_orderkey AS id, o_custkey AS client_id,
              round(avg(o_totalprice) OVER (PARTITION BY o_custkey), 6) AS client_mean,
              count(*) OVER (PARTITION BY o_custkey) AS client_rows FROM orders""",
)
def client_mean_window(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-partition window aggregates, computed without gathering a partition."""
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("client_id"), "o_totalprice"
    )
    stats = {"client_mean": F.avg("o_totalprice"), "client_rows": F.count("*")}
    out = features.group_stats(rows, ["client_id"], stats)
    return out.select("id", "client_id", F.round("client_mean", 6).alias("client_mean"), "client_rows")


@query(
    "drop_features",
    f"""WITH {SQL_FEATURED} SELECT amount, mcc, use_chip, yearly_income, gender, nation_id, transaction_hour,
        day_of_week, month, is_weekend, is_night_transaction, round(amount_vs_avg, 6) AS amount_vs_avg FROM featured""",
)
def drop_features(spark: SparkSession, folder: str) -> DataFrame:
    kept = features.drop_columns(featured(spark, folder))
    return kept.withColumn("amount_vs_avg", F.round("amount_vs_avg", 6))


_KINDS = ("click", "error", "purchase", "signup", "view")
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _indicators(column: str, values: tuple[str, ...], cast: str) -> str:
    return ", ".join(f"CAST({column} = '{v}' AS {cast}) AS \"{column}_{v}\"" for v in values)


@query(
    "one_hot_drop_first",
    f"""WITH {SQL_PRIMARY} SELECT id_transaction, {_indicators("use_chip", _KINDS[1:], "INTEGER")},
        {_indicators("gender", _SEGMENTS[1:], "INTEGER")} FROM primary_rows""",
)
def one_hot_drop_first(spark: SparkSession, folder: str) -> DataFrame:
    rows = primary(spark, folder).select("id_transaction", "use_chip", "gender")
    encoded = encode.one_hot(rows, encode.fit_categories(rows, features.CATEGORICAL_COLUMNS))
    return encoded.select("id_transaction", *[F.col(f"`{c}`").cast("int").alias(c) for c in encoded.columns[1:]])


@query(
    "align_schema",
    f"""WITH {SQL_FEATURED} SELECT id_transaction AS row_key, round(CAST(amount AS FLOAT)::DOUBLE, 4) AS amount,
        0.0::DOUBLE AS credit_score, CAST(transaction_hour AS DOUBLE) AS transaction_hour,
        CAST(is_weekend AS INTEGER)::DOUBLE AS is_weekend, CAST(use_chip = 'view' AS INTEGER)::DOUBLE AS use_chip_view,
        0.0::DOUBLE AS "use_chip_Online Transaction", CAST(gender = 'BUILDING' AS INTEGER)::DOUBLE AS "gender_BUILDING"
        FROM featured""",
)
def align_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Columns and order come from the stored list: absent ones are 0, the rest is dropped."""
    names = [
        "amount", "credit_score", "transaction_hour", "is_weekend", "use_chip_view",
        "use_chip_Online Transaction", "gender_BUILDING",
    ]
    rows = featured(spark, folder).withColumn("row_key", F.col("id_transaction"))
    stored = {"use_chip": list(_KINDS), "gender": list(_SEGMENTS)}
    aligned = encode.align(encode.one_hot(rows, stored, drop_first=False), names, keep=["row_key"])
    return aligned.select("row_key", *[F.round(F.col(f"`{n}`").cast("double"), 4).alias(n) for n in names])


_MATRIX_SQL = f"""round(CAST(amount AS FLOAT)::DOUBLE, 4) AS amount, CAST(mcc AS DOUBLE) AS mcc,
    round(CAST(yearly_income AS FLOAT)::DOUBLE, 3) AS yearly_income, CAST(nation_id AS DOUBLE) AS nation_id,
    CAST(transaction_hour AS DOUBLE) AS transaction_hour, CAST(day_of_week AS DOUBLE) AS day_of_week,
    CAST(month AS DOUBLE) AS month, CAST(is_weekend AS INTEGER)::DOUBLE AS is_weekend,
    CAST(is_night_transaction AS INTEGER)::DOUBLE AS is_night_transaction,
    round(CAST(amount_vs_avg AS FLOAT)::DOUBLE, 4) AS amount_vs_avg,
    {_indicators("use_chip", _KINDS[1:], "INTEGER").replace(" AS INTEGER)", " AS INTEGER)::DOUBLE")},
    {_indicators("gender", _SEGMENTS[1:], "INTEGER").replace(" AS INTEGER)", " AS INTEGER)::DOUBLE")}"""


def _readable(matrix: DataFrame) -> DataFrame:
    decimals = {"amount": 4, "amount_vs_avg": 4, "yearly_income": 3}
    return matrix.select(
        *[
            F.round(F.col(f"`{c}`").cast("double"), decimals.get(c, 0)).alias(c) if kind == "float" else F.col(c)
            for c, kind in matrix.dtypes
        ]
    )


@query("matrix", f"WITH {SQL_FEATURED} SELECT id_transaction AS row_key, {_MATRIX_SQL} FROM featured")
def matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = featured(spark, folder)
    categories = encode.fit_categories(primary(spark, folder), features.CATEGORICAL_COLUMNS)
    return _readable(scoring.prepare_matrix(rows, "id_transaction", categories))


@query(
    "downcast",
    """SELECT o_orderkey::INTEGER AS o_orderkey, o_custkey::INTEGER AS o_custkey,
              round(o_totalprice::FLOAT::DOUBLE, 1) AS o_totalprice, o_orderkey * 1000000 + 3000000000 AS wide FROM orders""",
)
def downcast(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", (F.col("o_orderkey") * 1000000 + 3000000000).alias("wide")
    )
    return encode.downcast(rows).withColumn("o_totalprice", F.round(F.col("o_totalprice").cast("double"), 1))


_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "column_ranges",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c}) AS min_value, max({c}) AS max_value FROM lineitem" for c in _NUMERIC
    ),
)
def column_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return encode.column_ranges(table(spark, folder, "lineitem"), _NUMERIC)


@query(
    "scaler_fit",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS feature, round(avg({c}), 6) AS mean,
        round(CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END, 6) AS deviation
        FROM (SELECT *, 5.0::DOUBLE AS constant FROM lineitem)"""
        for i, c in enumerate((*_NUMERIC, "constant"))
    ),
)
def scaler_fit(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").withColumn("constant", F.lit(5.0))
    fitted = scale.scaler_table(rows, [*_NUMERIC, "constant"])
    return fitted.select(
        "position", "feature", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation")
    )


@query(
    "scaler_apply",
    """SELECT event_id AS id, round(((value - avg(value) OVER ()) / stddev_pop(value) OVER ())::FLOAT::DOUBLE, 4) AS value,
              0.0::DOUBLE AS constant FROM events""",
)
def scaler_apply(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(F.col("event_id").alias("id"), "value", F.lit(5.0).alias("constant"))
    scaled = scale.apply_scaler(rows, scale.fit_scaler(rows, ["value", "constant"]), keep=["id"])
    return scaled.select(
        "id", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in ("value", "constant")]
    )


@query("head_rows", "SELECT event_id AS id, user_id AS client_id, ts AS date, value AS amount FROM events ORDER BY 1 LIMIT 5")
def head_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("client_id"), F.col("ts").alias("date"), F.col("value").alias("amount")
    )
    return rows.orderBy("id").limit(5)


@query(
    "sample_exact",
    f"""SELECT id, amount FROM (
        SELECT o_orderkey AS id, o_totalprice AS amount, count(*) OVER () AS n,
               row_number() OVER (ORDER BY {sql_draw(42, "o_orderkey")}, o_orderkey) AS r FROM orders)
        WHERE r <= round_even(n * 0.01::DOUBLE, 0)""",
)
def sample_exact(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return sampling.sample_exact(rows, "id", fraction=0.01)


@query(
    "split_exact",
    f"""SELECT id, r <= ceil(n * 0.15::DOUBLE) AS is_test FROM (
        SELECT o_orderkey AS id, count(*) OVER () AS n,
               row_number() OVER (ORDER BY {sql_draw(42, "o_orderkey")}, o_orderkey) AS r FROM orders)""",
)
def split_exact(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split_exact(table(spark, folder, "orders").select(F.col("o_orderkey").alias("id")), "id")


@query(
    "split_stratified",
    f"""WITH s AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
    t AS (SELECT *, sum(n) OVER () AS total FROM s),
    d AS (SELECT *, n * ceil(total * 0.15::DOUBLE) / total AS share, ceil(total * 0.15::DOUBLE) AS want FROM t),
    q AS (SELECT *, want - sum(floor(share)) OVER () AS spare,
                 row_number() OVER (ORDER BY floor(share) - share, event_type) AS pos FROM d),
    k AS (SELECT event_type, floor(share) + CASE WHEN pos <= spare THEN 1 ELSE 0 END AS take FROM q),
    r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type
                 ORDER BY {sql_draw(42, "event_id")}, event_id) AS r FROM events)
    SELECT event_id AS id, r.event_type AS stratum, r <= take AS is_test FROM r JOIN k ON r.event_type = k.event_type""",
)
def split_stratified(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("stratum"))
    return sampling.split_stratified(rows, "id", "stratum")


@query(
    "split_bernoulli",
    f"SELECT o_orderkey AS id, {sql_draw(42, 'o_orderkey')} < 0.15::DOUBLE AS is_test FROM orders",
)
def split_bernoulli(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.split_bernoulli(table(spark, folder, "orders").select(F.col("o_orderkey").alias("id")), "id")


@query(
    "cv_folds",
    f"SELECT o_orderkey AS id, floor({sql_draw(42, 'o_orderkey')} * 5)::INTEGER AS fold FROM orders",
)
def cv_folds(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.folds(table(spark, folder, "orders").select(F.col("o_orderkey").alias("id")), "id")


@query(
    "prepared_matrix",
    f"""WITH {SQL_FEATURED},
    drawn AS (SELECT *, count(*) OVER () AS n,
        row_number() OVER (ORDER BY {sql_draw("42:sample", "id_transaction")}, id_transaction) AS r FROM featured),
    sampled AS (SELECT *, count(*) OVER () AS m,
        row_number() OVER (ORDER BY {sql_draw("42:split", "id_transaction")}, id_transaction) AS q
        FROM drawn WHERE r <= round_even(n * 0.1::DOUBLE, 0))
    SELECT id_transaction AS row_key, q <= ceil(m * 0.15::DOUBLE) AS is_test, {_MATRIX_SQL} FROM sampled""",
)
def prepared_matrix(spark: SparkSession, folder: str) -> DataFrame:
    built, _ = scoring.prepare_training(featured(spark, folder), "id_transaction", fraction=0.1)
    return _readable(built)


@query(
    "clean_missing",
    """SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS amount,
              CASE WHEN event_type = 'signup' THEN 'unknown' ELSE event_type END AS use_chip,
              greatest(CASE WHEN user_id = 0 THEN NULL ELSE user_id END, 5) AS client_id FROM events""",
)
def clean_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Missing values replaced and out-of-range values limited by a rule table."""
    raw = table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("amount"),
        F.when(F.col("event_type") != "signup", F.col("event_type")).alias("use_chip"),
        F.when(F.col("user_id") != 0, F.col("user_id")).alias("client_id"),
    )
    rules = {
        "amount": F.coalesce("amount", F.lit(0.0)),
        "use_chip": F.coalesce("use_chip", F.lit("unknown")),
        "client_id": F.greatest("client_id", F.lit(5)),
    }
    return raw.withColumns(rules)


@query(
    "feature_schema",
    f"""WITH {SQL_PRIMARY} SELECT * FROM (VALUES (0, 'amount'), (1, 'mcc'), (2, 'yearly_income'), (3, 'nation_id')) v(position, feature),
        (SELECT 'v2.0' AS version)
        UNION ALL SELECT 3 + row_number() OVER (ORDER BY c, value), c || '_' || value, 'v2.0' FROM (
          SELECT * FROM (SELECT DISTINCT 'use_chip' AS c, use_chip AS value FROM primary_rows
                         UNION ALL SELECT DISTINCT 'gender', gender FROM primary_rows)
          QUALIFY row_number() OVER (PARTITION BY c ORDER BY value) > 1)""",
)
def feature_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Ordered, versioned feature list derived from the data."""
    rows = features.drop_columns(features.clean(primary(spark, folder)))
    categories = encode.fit_categories(rows, sorted(features.CATEGORICAL_COLUMNS))
    names = encode.one_hot(rows, categories).columns
    return spark.createDataFrame(
        [(i, n, "v2.0") for i, n in enumerate(names)], "position int, feature string, version string"
    )
