"""Detector evaluation, comparison, registry and exploration queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.functions import decisions, names
from spendwatch.operators import classify, detectors, profile, quality
from spendwatch.operators.quantiles import exact_quantiles
from spendwatch.operators.sampling import folds
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import SQL_FEATURED, featured, mcc_code, sql_draw, table
from spendwatch.plans.model_queries import SQL_EXPLORED, explored
from spendwatch.session import cut_lineage, scratch_path
from spendwatch.sources import files, registry

DIMENSIONS = 64
VECTOR = [f"x{i}" for i in range(DIMENSIONS)]


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as one column per dimension, with a two-way label."""
    parts = [f"embedding[{i}] AS x{i}" for i in range(DIMENSIONS)]
    return table(spark, folder, "embeddings").selectExpr("vec_id", "label", "if(label < 2, -1, 1) AS prediction", *parts)


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions flagged by a fixed rule: large amounts at night."""
    rows = featured(spark, folder)
    odd = (F.col("amount") > 100) | (F.col("is_night_transaction") & (F.col("amount") > 60))
    return rows.withColumn("prediction", F.when(odd, decisions.ANOMALY).otherwise(decisions.NORMAL))


SQL_FLAGGED = f"""{SQL_FEATURED}, flagged AS (SELECT *, CASE WHEN amount > 100 OR (is_night_transaction AND amount > 60)
    THEN -1 ELSE 1 END AS prediction FROM featured)"""


@query(
    "anomaly_summary",
    f"""WITH {SQL_FLAGGED} SELECT count(*) AS total_samples, count_if(prediction = -1) AS anomalies_detected,
        count_if(prediction = 1) AS normal_samples, round(avg((prediction = -1)::INTEGER), 5) AS anomaly_rate,
        count(DISTINCT prediction) AS distinct_labels FROM flagged""",
)
def anomaly_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.anomaly_summary(flagged(spark, folder))


@query(
    "value_counts",
    """SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1""",
)
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(table(spark, folder, "events"), "event_type")


_PROFILED = ("amount", "transaction_hour", "amount_vs_avg", "yearly_income")


def _describe_sql(source: str, columns: tuple[str, ...], by: str) -> str:
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {lead}'{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
        round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75, round(max({c})::DOUBLE, 4) AS max FROM {source} {group}"""
        for c in columns
    )


def _rounded(described: DataFrame, keys: list[str]) -> DataFrame:
    return described.select(
        *keys, "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    )


@query(
    "describe_by_label",
    f"""{SQL_EXPLORED}, judged AS (SELECT f.*, s.prediction FROM featured f JOIN e_scored s ON f.id_transaction = s.row_key)
    {_describe_sql("judged", _PROFILED, "prediction")}""",
)
def describe_by_label(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of forest anomalies against normal transactions."""
    # written once: the quantiles take several passes, each of which would score all rows again
    rows = cut_lineage(explored(spark, folder, keep=_PROFILED).select("prediction", *_PROFILED))
    return _rounded(profile.describe(rows, _PROFILED, ["prediction"]), ["prediction", "column_name"])


_LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("describe_all", _describe_sql("lineitem", _LINE_COLUMNS, ""))
def describe_all(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.describe(table(spark, folder, "lineitem"), _LINE_COLUMNS), ["column_name"])


@query("quantile99", "SELECT 'value' AS column_name, 0.99::DOUBLE AS prob, round(quantile_cont(value, 0.99), 6) AS quantile FROM events")
def quantile99(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_quantiles(table(spark, folder, "events"), ["value"], [0.99])
    return found.withColumn("quantile", F.round("quantile", 6))


_EVENT_TYPES = {
    "event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string",
}


@query(
    "table_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count({c}) AS n_present,
        count(*) - count({c}) AS n_missing FROM events"""
        for c, t in _EVENT_TYPES.items()
    ),
)
def table_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.table_profile(table(spark, folder, "events"))


@query(
    "hist_density",
    f"""WITH {SQL_FLAGGED}, e AS (SELECT prediction AS label, min(amount) AS lo, max(amount) AS hi, count(*) AS n FROM flagged GROUP BY 1),
    b AS (SELECT label, lo, hi, n, least(floor((amount - lo) / ((hi - lo) / 100)), 99)::INTEGER AS bin
          FROM flagged JOIN e ON prediction = label)
    SELECT label, bin, round(lo + bin * ((hi - lo) / 100), 6) AS bin_start, count(*) AS rows_in_bin,
           round(count(*) / (n * ((hi - lo) / 100)), 6) AS density FROM b GROUP BY label, bin, lo, hi, n""",
)
def hist_density(spark: SparkSession, folder: str) -> DataFrame:
    made = profile.density_histogram(flagged(spark, folder), "amount", "prediction")
    return made.withColumns({c: F.round(c, 6) for c in ("bin_start", "density")})


@query(
    "kde",
    f"""WITH {SQL_FLAGGED}, v AS (SELECT prediction AS label, amount AS x, count(*) AS w FROM flagged GROUP BY 1, 2),
    s AS (SELECT prediction AS label, count(*) AS n, stddev_samp(amount) * power(count(*)::DOUBLE, -0.2) AS h,
          min(amount) AS lo, max(amount) AS hi FROM flagged GROUP BY 1),
    g AS (SELECT label, n, h, i AS point, lo - 3 * h + i * ((hi + 3 * h - (lo - 3 * h)) / 199) AS gx FROM s, range(200) r(i))
    SELECT g.label, point::INTEGER AS point, round(gx, 6) AS x,
           round(sum(w * exp(-0.5 * power((gx - v.x) / h, 2))) / (n * h * sqrt(2 * pi())), 8) AS density
    FROM g JOIN v ON g.label = v.label GROUP BY g.label, point, gx, n, h""",
)
def kde(spark: SparkSession, folder: str) -> DataFrame:
    curve = profile.density_curve(flagged(spark, folder), "amount", "prediction")
    return curve.select("label", "point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


_SQL_DISTANCE = "(SELECT sum(power(a::DOUBLE - b, 2)) FROM (SELECT unnest({a}) AS a, unnest({b}) AS b))"

_SQL_CLUSTERS = """long AS (SELECT vec_id, CASE WHEN label < 2 THEN -1 ELSE 1 END AS k, d, embedding[d + 1]::DOUBLE AS x
    FROM embeddings, range(64) r(d)),
c AS (SELECT k, d, avg(x) AS m, count(*) AS n FROM long GROUP BY 1, 2),
r AS (SELECT vec_id, long.k, sum(power(x - m, 2)) AS ss FROM long JOIN c ON long.k = c.k AND long.d = c.d GROUP BY 1, 2)"""


@query(
    "calinski_harabasz",
    f"""WITH {_SQL_CLUSTERS}, w AS (SELECT sum(ss) AS within, count(*) AS n FROM r),
    a AS (SELECT d, avg(x) AS m FROM long GROUP BY 1),
    b AS (SELECT sum(c.n * power(c.m - a.m, 2)) AS between, count(DISTINCT k) AS k FROM c JOIN a ON c.d = a.d)
    SELECT k AS clusters, n AS n_rows, round(between * (n - k) / (within * (k - 1)), 4) AS score FROM w, b""",
)
def calinski_harabasz(spark: SparkSession, folder: str) -> DataFrame:
    return quality.calinski_harabasz(vectors(spark, folder), VECTOR)


@query(
    "davies_bouldin",
    f"""WITH {_SQL_CLUSTERS}, s AS (SELECT k, avg(sqrt(ss)) AS spread, count(*) AS n FROM r GROUP BY 1),
    m AS (SELECT a.k AS i, b.k AS j, sqrt(sum(power(a.m - b.m, 2))) AS apart FROM c a JOIN c b ON a.d = b.d AND a.k <> b.k GROUP BY 1, 2),
    t AS (SELECT i, max((x.spread + y.spread) / apart) AS worst FROM m JOIN s x ON i = x.k JOIN s y ON j = y.k GROUP BY 1)
    SELECT count(*) AS clusters, (SELECT sum(n)::BIGINT FROM s) AS n_rows, round(avg(worst), 4) AS score FROM t""",
)
def davies_bouldin(spark: SparkSession, folder: str) -> DataFrame:
    return quality.davies_bouldin(vectors(spark, folder), VECTOR)


@query(
    "silhouette_euclid",
    """WITH s AS (SELECT vec_id, CASE WHEN label < 2 THEN -1 ELSE 1 END AS k, embedding FROM embeddings), p AS (SELECT a.vec_id, a.k, b.k AS other,
        sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS total, count(*) AS n
        FROM s a, s b GROUP BY 1, 2, 3),
    i AS (SELECT vec_id, max(CASE WHEN k = other THEN CASE WHEN n > 1 THEN total / (n - 1) END END) AS a,
          min(CASE WHEN k <> other THEN total / n END) AS b FROM p GROUP BY 1)
    SELECT count(*) AS n_rows, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS score FROM i""",
)
def silhouette_euclid(spark: SparkSession, folder: str) -> DataFrame:
    return quality.silhouette_euclidean(vectors(spark, folder), VECTOR, "prediction", "vec_id")


@query(
    "silhouette_sq",
    """WITH s AS (SELECT vec_id, CASE WHEN label < 2 THEN -1 ELSE 1 END AS k, embedding FROM embeddings),
    p AS (SELECT a.vec_id, a.k, b.k AS other, sum(power(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 2)) AS total,
          count(*) AS n FROM s a, s b GROUP BY 1, 2, 3),
    i AS (SELECT vec_id, max(CASE WHEN k = other THEN CASE WHEN n > 1 THEN total / (n - 1) END END) AS a,
          min(CASE WHEN k <> other THEN total / n END) AS b FROM p GROUP BY 1)
    SELECT count(*) AS n_rows, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 4) AS score FROM i""",
)
def silhouette_sq(spark: SparkSession, folder: str) -> DataFrame:
    return quality.silhouette_squared(vectors(spark, folder), VECTOR, "prediction")


def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """Artifact names and save times, one per event."""
    kind = (
        F.when(F.col("event_type") == "purchase", "isolation_forest")
        .when(F.col("event_type") == "view", "lof_i3_optimized")
        .when(F.col("event_type") == "click", "one_class_svm_model")
        .otherwise("hierarchical_lof")
    )
    tail = F.when(F.col("event_type") == "signup", ".pkl").otherwise(".joblib")
    stamped = names.artifact_name(kind, F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select(
        F.concat(stamped, tail).alias("name"), F.col("ts").alias("mtime"), "event_id", "event_type", "value"
    )


SQL_ARTIFACTS = """artifacts AS (SELECT CASE event_type WHEN 'purchase' THEN 'isolation_forest' WHEN 'view' THEN 'lof_i3_optimized'
    WHEN 'click' THEN 'one_class_svm_model' ELSE 'hierarchical_lof' END || '_' || strftime(ts, '%Y%m%d_%H%M%S')
    || CASE event_type WHEN 'signup' THEN '.pkl' ELSE '.joblib' END AS name, ts AS mtime, event_id, event_type, value FROM events)"""


@query(
    "registry_latest",
    f"""WITH {SQL_ARTIFACTS} SELECT name, mtime FROM artifacts WHERE name LIKE '%isolation_forest%.joblib'
        ORDER BY mtime DESC, name DESC LIMIT 1""",
)
def registry_latest(spark: SparkSession, folder: str) -> DataFrame:
    return registry.latest_artifact(artifacts(spark, folder))


@query(
    "registry_all",
    f"""WITH {SQL_ARTIFACTS} SELECT name, mtime, event_id FROM artifacts WHERE name LIKE '%\\_i3\\_optimized\\_%.joblib' ESCAPE '\\'""",
)
def registry_all(spark: SparkSession, folder: str) -> DataFrame:
    return registry.matching_artifacts(artifacts(spark, folder)).select("name", "mtime", "event_id")


@query(
    "model_name",
    f"""WITH {SQL_ARTIFACTS} SELECT CASE event_type WHEN 'purchase' THEN 'isolation_forest' WHEN 'view' THEN 'lof'
        WHEN 'click' THEN 'one_class_svm' ELSE 'hierarchical_lof' END AS model_name, count(*) AS n FROM artifacts GROUP BY 1""",
)
def model_name(spark: SparkSession, folder: str) -> DataFrame:
    named = artifacts(spark, folder).select(names.model_name(F.col("name")).alias("model_name"))
    return named.groupBy("model_name").agg(F.count("*").alias("n"))


@query(
    "detector_type",
    """SELECT event_id AS id, CASE event_type WHEN 'view' THEN 'hierarchical_lof' WHEN 'click' THEN 'hierarchical_svm'
        WHEN 'signup' THEN 'dict_artifact' WHEN 'error' THEN CASE WHEN value < 20 THEN 'fit_predict_only' ELSE 'unknown' END
        ELSE CASE WHEN value < 20 THEN 'standard_predict' WHEN value < 60 THEN 'decision_function' ELSE 'score_samples' END END AS detector_type
        FROM events""",
)
def detector_type(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    parts = lambda *items: F.array(*[F.lit(i) for i in items])
    members = (
        F.when(kind == "view", parts("clusterer", "lof_models"))
        .when(kind == "click", parts("approximator", "svm_model"))
        .when(kind == "signup", parts("model", "scaler"))
    )
    methods = (
        F.when((kind == "purchase") & (F.col("value") < 20), parts("predict", "decision_function"))
        .when((kind == "purchase") & (F.col("value") < 60), parts("decision_function", "score_samples"))
        .when(kind == "purchase", parts("score_samples"))
        .when((kind == "error") & (F.col("value") < 20), parts("fit_predict"))
        .otherwise(parts("transform"))
    )
    return events.select(F.col("event_id").alias("id"), names.detector_kind(members, methods).alias("detector_type"))


def model_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Per model name: rows scored, seconds taken and labels, from the events."""
    return artifacts(spark, folder).select(
        names.model_name(F.col("name")).alias("model_name"),
        (F.col("value") / 1000).alias("seconds"),
        F.when(F.col("value") > 60, decisions.ANOMALY).otherwise(decisions.NORMAL).alias("prediction"),
    )


_SQL_MODEL = """CASE event_type WHEN 'purchase' THEN 'isolation_forest' WHEN 'view' THEN 'lof'
    WHEN 'click' THEN 'one_class_svm' ELSE 'hierarchical_lof' END"""
SQL_RUNS = f"runs AS (SELECT {_SQL_MODEL} AS model_name, value / 1000 AS seconds, CASE WHEN value > 60 THEN -1 ELSE 1 END AS prediction FROM events)"


@query(
    "model_comparison",
    f"""WITH {SQL_RUNS} SELECT model_name, count(*) AS total_samples, count_if(prediction = -1) AS anomalies_detected,
        count_if(prediction = 1) AS normal_samples, round(avg((prediction = -1)::INTEGER), 5) AS anomaly_rate FROM runs GROUP BY 1""",
)
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return detectors.compare_models(model_runs(spark, folder))


def _performance(spark: SparkSession, folder: str) -> DataFrame:
    totals = model_runs(spark, folder).groupBy("model_name").agg(
        F.count("*").alias("samples"), F.sum("seconds").alias("seconds")
    )
    return detectors.performance(totals, F.col("samples"), F.col("seconds")).drop("seconds")


_SQL_PERFORMANCE = f"""WITH {SQL_RUNS}, t AS (SELECT model_name, count(*) AS samples, sum(seconds) AS s FROM runs GROUP BY 1),
    perf AS (SELECT model_name, samples, round(s, 4) AS inference_time_seconds, round(samples / s, 2) AS throughput,
    round(samples / s / 4, 2) AS samples_per_core_per_second, round(round(samples / s, 2) * 3600, 0) AS hourly_capacity FROM t)"""


@query("perf_table", f"{_SQL_PERFORMANCE} SELECT * FROM perf")
def perf_table(spark: SparkSession, folder: str) -> DataFrame:
    return _performance(spark, folder)


@query("best_model", f"{_SQL_PERFORMANCE} SELECT model_name, throughput FROM perf ORDER BY throughput DESC, model_name LIMIT 1")
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    order = F.when(F.col("model_name") == "hierarchical_lof", 0).when(F.col("model_name") == "isolation_forest", 1)
    listed = _performance(spark, folder).withColumn("position", order.when(F.col("model_name") == "lof", 2).otherwise(3))
    return detectors.best_model(listed, "position")


@query(
    "report_sink",
    f"""WITH {SQL_RUNS} SELECT model_name, count(*) AS total_samples, count_if(prediction = -1) AS anomalies_detected,
        count_if(prediction = 1) AS normal_samples, round(avg((prediction = -1)::INTEGER), 5) AS anomaly_rate,
        'v1' AS meta_report_version FROM runs GROUP BY 1""",
)
def report_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "report")
    files.write_report(detectors.compare_models(model_runs(spark, folder)), path, {"report_version": "v1"})
    return spark.read.schema(
        "model_name string, total_samples bigint, anomalies_detected bigint, normal_samples bigint, "
        "anomaly_rate double, meta_report_version string"
    ).json(path)


@query(
    "scoring_log_summary",
    """WITH log AS (SELECT CAST(regexp_extract(props, '[0-9]+') AS INTEGER) + 1 AS batch_size, value / 1000 AS seconds,
           event_type <> 'error' AS success, CAST(ts AS DATE) AS day FROM events)
    SELECT day, sum(batch_size)::BIGINT AS predictions_made, sum(CASE WHEN success THEN batch_size ELSE 0 END)::BIGINT AS success_count,
        round(sum(CASE WHEN success THEN batch_size ELSE 0 END) / sum(batch_size) * 100, 1) AS success_rate,
        round(sum(seconds) / sum(batch_size) * 1000, 2) AS avg_inference_time_ms,
        round(sum(batch_size) / sum(seconds), 0) AS throughput FROM log GROUP BY 1""",
)
def scoring_log_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Daily summary of an append-only log, written and read back as the audit record."""
    path = scratch_path(spark, "scoring_log")
    log = table(spark, folder, "events").select(
        (mcc_code(F.col("props")) + 1).alias("batch_size"),
        (F.col("value") / 1000).alias("seconds"),
        (F.col("event_type") != "error").alias("success"),
        F.col("ts").cast("date").alias("day"),
    )
    log.write.mode("append").parquet(path)
    return detectors.scoring_log_summary(spark.read.parquet(path), ["day"])


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """Error events as fraud, a score from the amount, and a cut on it."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "error").alias("actual"),
        F.col("value").alias("score"),
        (F.col("value") > 40).alias("predicted"),
    )


@query(
    "classification_metrics",
    """WITH c AS (SELECT count_if(a AND p) AS tp, count_if(NOT a AND p) AS fp, count_if(a AND NOT p) AS fn, count_if(NOT a AND NOT p) AS tn
        FROM (SELECT event_type = 'error' AS a, value > 40 AS p FROM events))
    SELECT tp AS true_positive, fp AS false_positive, fn AS false_negative, tn AS true_negative, round(tp / (tp + fp), 6) AS precision,
        round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round(fp / (fp + tn), 6) AS false_positive_rate,
        tp / (tp + fn) >= 0.9 AND tp / (tp + fp) >= 0.85 AND fp / (fp + tn) <= 0.02 AS meets_targets FROM c""",
)
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    made = classify.confusion_metrics(judged(spark, folder), "actual", "predicted")
    return made.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "false_positive_rate")})


@query(
    "auc",
    """WITH d AS (SELECT value AS s, event_type = 'error' AS a FROM events),
    r AS (SELECT a, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM d),
    n AS (SELECT count_if(a) AS p, count_if(NOT a) AS q, sum(CASE WHEN a THEN r END) AS s FROM r)
    SELECT p AS positives, q AS negatives, round((s - p * (p + 1) / 2.0) / (p::DOUBLE * q), 8) AS auc FROM n""",
)
def auc(spark: SparkSession, folder: str) -> DataFrame:
    return classify.auc(judged(spark, folder), "actual", "score").withColumn("auc", F.round("auc", 8))


@query(
    "cv_metrics",
    f"""WITH d AS (SELECT floor({sql_draw(42, "event_id")} * 5)::INTEGER AS fold, event_type = 'error' AS a, value > 40 AS p FROM events)
    SELECT fold, count(*) AS n, round(count_if(a AND p) / count_if(p), 6) AS precision, round(count_if(a AND p) / count_if(a), 6) AS recall
    FROM d GROUP BY 1""",
)
def cv_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = folds(judged(spark, folder), "id")
    hit = F.count_if(F.col("actual") & F.col("predicted"))
    return rows.groupBy("fold").agg(
        F.count("*").alias("n"),
        F.round(F.try_divide(hit, F.count_if("predicted")), 6).alias("precision"),
        F.round(F.try_divide(hit, F.count_if("actual")), 6).alias("recall"),
    )


@query(
    "ab_test",
    """WITH m AS (SELECT count(*) FILTER (g = 'view') AS n0, count(*) FILTER (g = 'click') AS n1, avg(v) FILTER (g = 'view') AS m0,
        avg(v) FILTER (g = 'click') AS m1, var_samp(v) FILTER (g = 'view') AS v0, var_samp(v) FILTER (g = 'click') AS v1
        FROM (SELECT event_type AS g, value AS v FROM events))
    SELECT n0 AS n_control, n1 AS n_treatment, round(m0, 6) AS mean_control, round(m1, 6) AS mean_treatment, round(m1 - m0, 6) AS difference,
        round((m1 - m0) / sqrt(v0 / n0 + v1 / n1), 6) AS t_statistic,
        round(power(v0 / n0 + v1 / n1, 2) / (power(v0 / n0, 2) / (n0 - 1) + power(v1 / n1, 2) / (n1 - 1)), 3) AS degrees_of_freedom FROM m""",
)
def ab_test(spark: SparkSession, folder: str) -> DataFrame:
    made = classify.compare_groups(table(spark, folder, "events"), "event_type", "value", "view", "click")
    rounded = {c: F.round(c, 6) for c in ("mean_control", "mean_treatment", "difference", "t_statistic")}
    return made.withColumns({**rounded, "degrees_of_freedom": F.round("degrees_of_freedom", 3)})


_DRIFT_SPLIT = "1997-01-01"


def _psi_sql(column: str) -> str:
    quantiles = ", ".join(f"{i / 10}" for i in range(1, 10))
    return f"""SELECT '{column}' AS column_name, round(sum((q - p) * ln(q / p)), 6) AS psi FROM (
      SELECT b, greatest(coalesce(sum(CASE WHEN NOT late THEN n END), 0) / (SELECT count(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '{_DRIFT_SPLIT}'), 1e-6) AS p,
             greatest(coalesce(sum(CASE WHEN late THEN n END), 0) / (SELECT count(*) FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_DRIFT_SPLIT}'), 1e-6) AS q
      FROM range(10) g(b) LEFT JOIN (
        SELECT l_shipdate >= TIMESTAMP '{_DRIFT_SPLIT}' AS late, len(list_filter(e, lambda x: {column} > x)) AS bin, count(*) AS n
        FROM lineitem, (SELECT quantile_cont({column}, [{quantiles}]) AS e FROM lineitem WHERE l_shipdate < TIMESTAMP '{_DRIFT_SPLIT}')
        GROUP BY 1, 2) ON b = bin GROUP BY b)"""


@query("psi_drift", " UNION ALL ".join(_psi_sql(c) for c in ("l_quantity", "l_extendedprice")))
def psi_drift(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    split = F.lit(_DRIFT_SPLIT).cast("timestamp_ntz")
    early, late = lines.filter(F.col("l_shipdate") < split), lines.filter(F.col("l_shipdate") >= split)
    made = classify.population_stability(early, late, ["l_quantity", "l_extendedprice"])
    return made.withColumn("psi", F.round("psi", 6))


@query(
    "ensemble_vote",
    f"""WITH {SQL_FEATURED}, v AS (SELECT id_transaction, (amount > 100)::INTEGER + (amount_vs_avg > 3)::INTEGER
        + (is_night_transaction AND amount > 60)::INTEGER AS votes, is_night_transaction AND amount > 150 AS rule_hit FROM featured)
    SELECT id_transaction, votes, rule_hit, CASE WHEN votes * 2 > 3 THEN -1 ELSE 1 END AS prediction,
        CASE WHEN votes >= 2 THEN 'block' WHEN votes > 0 OR rule_hit THEN 'alert' ELSE 'allow' END AS action FROM v""",
)
def ensemble_vote(spark: SparkSession, folder: str) -> DataFrame:
    rows = featured(spark, folder)
    detectors_ = {
        "amount": F.col("amount") > 100,
        "ratio": F.col("amount_vs_avg") > 3,
        "night": F.col("is_night_transaction") & (F.col("amount") > 60),
    }
    votes = rows.select(
        "id_transaction",
        (F.col("is_night_transaction") & (F.col("amount") > 150)).alias("rule"),
        F.explode(
            F.array(*[F.when(test, decisions.ANOMALY).otherwise(decisions.NORMAL) for test in detectors_.values()])
        ).alias("prediction"),
    )
    return detectors.ensemble(votes, "id_transaction", F.col("rule"), block_at=2)
