"""Forest fitting, scoring, persistence and scoring policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.functions import decisions
from spendwatch.operators import encode, features, forests, iforest, quality, scoring
from spendwatch.operators.quantiles import exact_quantiles
from spendwatch.operators.sampling import folds
from spendwatch.plans import forest_sql
from spendwatch.plans.catalog import query
from spendwatch.plans.datasets import SQL_FEATURED, featured, sql_draw, table
from spendwatch.session import cut_lineage, scratch_path
from spendwatch.sources import registry

KINDS = ("click", "error", "purchase", "signup", "view")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
NUMERIC = (
    "amount", "mcc", "yearly_income", "nation_id", "transaction_hour", "day_of_week", "month",
    "is_weekend", "is_night_transaction", "amount_vs_avg",
)
INDICATORS = tuple(f"use_chip_{k}" for k in KINDS[1:]) + tuple(f"gender_{s}" for s in SEGMENTS[1:])
FEATURES = NUMERIC + INDICATORS
RUN = "20240131_000000"


def _float(column: str) -> str:
    kind = "::INTEGER" if column.startswith("is_") else ""
    return f'{column}{kind}::FLOAT AS "{column}"'


_COLUMNS = ", ".join(
    [_float(c) for c in NUMERIC]
    + [f"(use_chip = '{k}')::INTEGER::FLOAT AS \"use_chip_{k}\"" for k in KINDS[1:]]
    + [f"(gender = '{s}')::INTEGER::FLOAT AS \"gender_{s}\"" for s in SEGMENTS[1:]]
)
_SCALED = ", ".join(
    f"""((m."{f}"::DOUBLE - s."{f}_m") / s."{f}_s")::FLOAT AS "{f}" """ for f in FEATURES
)
_STATS = ", ".join(
    f"""avg("{f}"::DOUBLE) AS "{f}_m", CASE WHEN stddev_pop("{f}"::DOUBLE) = 0 THEN 1 ELSE stddev_pop("{f}"::DOUBLE) END AS "{f}_s" """
    for f in FEATURES
)

SQL_MATRIX = f"""{SQL_FEATURED},
plain AS MATERIALIZED (SELECT id_transaction AS row_key, {_COLUMNS},
   row_number() OVER (ORDER BY {sql_draw("42:split", "id_transaction")}, id_transaction)
     <= ceil(count(*) OVER () * 0.15::DOUBLE) AS is_test FROM featured)"""

SQL_SCALED = f"""{SQL_MATRIX},
train_stats AS (SELECT {_STATS} FROM plain WHERE NOT is_test),
scaled AS MATERIALIZED (SELECT m.row_key, m.is_test, {_SCALED} FROM plain m, train_stats s),
fitting AS MATERIALIZED (SELECT * FROM scaled WHERE NOT is_test)"""

_PRODUCTION = dict(trees=150, max_features=0.8, bootstrap=True, sub_sample=256)
_EXPLORATION = dict(trees=100, max_features=1.0, bootstrap=False, sub_sample=256)

SQL_FITTED = f"WITH {SQL_SCALED},\n" + forest_sql.grow("p", "fitting", FEATURES, **_PRODUCTION)
SQL_SCORED = SQL_FITTED + ",\n" + forest_sql.walk("p", "scaled", FEATURES, 150, 256, 0.1, "NOT is_test")
SQL_EXPLORED = (
    f"WITH {SQL_MATRIX},\n"
    + forest_sql.grow("e", "plain", FEATURES, **_EXPLORATION)
    + ",\n"
    + forest_sql.walk("e", "plain", FEATURES, 100, 256, 0.001, "true")
)


def trained(spark: SparkSession, folder: str) -> tuple[scoring.Detector, DataFrame]:
    """Production forest on the training part of the whole table, and the marked matrix."""
    matrix, categories = scoring.prepare_training(featured(spark, folder), "id_transaction", fraction=1.0)
    return scoring.train(matrix, categories, RUN, **iforest.PRODUCTION_FOREST), matrix


def explored(spark: SparkSession, folder: str, keep: Sequence[str] = ()) -> DataFrame:
    """All rows labelled by the exploration forest, which is fitted on them unscaled."""
    rows = cut_lineage(featured(spark, folder))
    categories = encode.fit_categories(rows, features.CATEGORICAL_COLUMNS)
    matrix = scoring.prepare_matrix(rows, "id_transaction", categories)
    names = scoring.matrix_features(matrix)
    forest = iforest.fit_forest(matrix, "row_key", names, **iforest.EXPLORATION_FOREST)
    detector = scoring.Detector("isolation_forest", RUN, names, categories, None, forest)
    return scoring.score(rows, detector, keep=["id_transaction", *keep])


@query(
    "iforest_fit",
    SQL_FITTED + " SELECT tree::INTEGER AS tree, node::INTEGER AS node, feature::INTEGER AS feature, "
    "round(split, 4) AS split, size::INTEGER AS size, round(path, 6) AS path FROM p_nodes",
)
def iforest_fit(spark: SparkSession, folder: str) -> DataFrame:
    matrix, _ = scoring.prepare_training(featured(spark, folder), "id_transaction", fraction=1.0)
    names = scoring.matrix_features(matrix)
    rows = matrix.filter("NOT is_test")
    ready = scoring.apply_scaler(rows, scoring.fit_scaler(rows, names), keep=["row_key"])
    parameters = {k: v for k, v in iforest.PRODUCTION_FOREST.items() if k != "contamination"}
    nodes, _ = iforest.fit_nodes(ready, "row_key", names, **parameters)
    return nodes.select(
        "tree", "node", "feature", F.round("split", 4).alias("split"), "size", F.round("path", 6).alias("path")
    )


@query("iforest_eda", SQL_EXPLORED + " SELECT prediction, count(*) AS n FROM e_scored GROUP BY 1")
def iforest_eda(spark: SparkSession, folder: str) -> DataFrame:
    return explored(spark, folder).groupBy("prediction").agg(F.count("*").alias("n"))


@query(
    "filter_anomalies",
    SQL_EXPLORED + " SELECT row_key AS id_transaction, round(path_length, 6) AS path_length FROM e_scored WHERE prediction = -1",
)
def filter_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    flagged = explored(spark, folder).filter(F.col("prediction") == decisions.ANOMALY)
    return flagged.select("id_transaction", F.round("path_length", 6).alias("path_length"))


@query(
    "iforest_score",
    SQL_SCORED + " SELECT row_key, round(path_length, 6) AS path_length, round(score, 6) AS score FROM p_scored",
)
def iforest_score(spark: SparkSession, folder: str) -> DataFrame:
    detector, matrix = trained(spark, folder)
    ready = scoring.apply_scaler(matrix, detector.scaler, keep=["row_key"])
    return iforest.with_scores(ready, detector.forest).select(
        "row_key", F.round("path_length", 6).alias("path_length"), F.round("score", 6).alias("score")
    )


@query(
    "iforest_label",
    SQL_SCORED + " SELECT row_key, round(decision, 6) AS decision, prediction FROM p_scored",
)
def iforest_label(spark: SparkSession, folder: str) -> DataFrame:
    detector, matrix = trained(spark, folder)
    ready = scoring.apply_scaler(matrix, detector.scaler, keep=["row_key"])
    scored = iforest.with_scores(ready, detector.forest)
    return scored.select(
        "row_key",
        F.round("decision", 6).alias("decision"),
        decisions.label_from_decision(F.col("decision")).alias("prediction"),
    )


@query(
    "validate_model",
    SQL_SCORED + """ SELECT round(avg((prediction = -1)::INTEGER), 5) AS anomaly_rate, 18 AS feature_count,
                            count(*) AS sample_count FROM p_scored WHERE NOT fits""",
)
def validate_model(spark: SparkSession, folder: str) -> DataFrame:
    detector, matrix = trained(spark, folder)
    held_out = scoring.apply_scaler(matrix.filter("is_test"), detector.scaler, keep=["row_key"])
    scored = iforest.with_scores(held_out, detector.forest).withColumn(
        "prediction", decisions.label_from_decision(F.col("decision"))
    )
    return quality.anomaly_summary(scored).select(
        "anomaly_rate", F.lit(len(detector.features)).alias("feature_count"), F.col("total_samples").alias("sample_count")
    )


_SQL_RESPONSE = """prediction, CASE WHEN prediction = -1 THEN 'ANOMALIA' ELSE 'NORMAL' END AS prediction_label,
    round(1 / (1 + exp(-abs(decision))), 6) AS confidence_score, 'isolation_forest' AS model_type,
    '20240131_000000' AS model_path, true AS success"""


def _response(scored: DataFrame, *extra: str) -> DataFrame:
    return scored.select(
        *extra, "prediction", "prediction_label", F.round("confidence_score", 6).alias("confidence_score"),
        "model_type", "model_path", "success",
    )


@query("score_batch", SQL_SCORED + f" SELECT row_key AS id_transaction, {_SQL_RESPONSE} FROM p_scored")
def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    detector, _ = trained(spark, folder)
    return _response(scoring.score(featured(spark, folder), detector, keep=["id_transaction"]), "id_transaction")


@query("model_save_load", SQL_SCORED + f" SELECT row_key AS id_transaction, {_SQL_RESPONSE} FROM p_scored")
def model_save_load(spark: SparkSession, folder: str) -> DataFrame:
    """The response of a detector that went through the model tables."""
    detector, _ = trained(spark, folder)
    root = scratch_path(spark, "models")
    registry.save_detector(spark, detector, root, RUN)
    restored = registry.latest_detector(spark, root)
    return _response(scoring.score(featured(spark, folder), restored, keep=["id_transaction"]), "id_transaction")


@query(
    "model_status",
    f"""WITH {SQL_FEATURED} SELECT 'isolation_forest' AS type, '20240131_000000' AS path,
        10 + count(DISTINCT use_chip) - 1 + count(DISTINCT gender) - 1 AS features_count, true AS has_scaler FROM featured""",
)
def model_status(spark: SparkSession, folder: str) -> DataFrame:
    detector, _ = trained(spark, folder)
    row = registry.status(detector)
    return spark.createDataFrame(
        [tuple(row.values())], "type string, path string, features_count bigint, has_scaler boolean"
    )


def record_text(spark: SparkSession, folder: str, break_errors: bool) -> DataFrame:
    """Featured transactions as one JSON record per row; ``error`` events cut short on demand."""
    rows = featured(spark, folder)
    names = ["id_transaction", "use_chip", "gender", *NUMERIC]
    as_number = [
        F.col(n).cast("int").alias(n) if n.startswith("is_") else F.col(n) for n in names
    ]
    text = F.to_json(F.struct(*as_number))
    cut = F.substring(text, 1, 25)
    return rows.select(F.when((F.col("use_chip") == "error") & F.lit(break_errors), cut).otherwise(text).alias("text"))


@query("score_json", SQL_SCORED + " SELECT row_key AS id_transaction, prediction, true AS success FROM p_scored")
def score_json(spark: SparkSession, folder: str) -> DataFrame:
    detector, _ = trained(spark, folder)
    scored = scoring.score_json(record_text(spark, folder, False), "text", detector, "id_transaction")
    return scored.select("id_transaction", "prediction", "success")


@query(
    "score_bad_rows",
    SQL_SCORED + """ SELECT CASE WHEN e.event_type <> 'error' THEN row_key ELSE -1 END AS id_transaction,
        CASE WHEN e.event_type <> 'error' THEN prediction ELSE 0 END AS prediction,
        CASE WHEN e.event_type = 'error' THEN 'none' WHEN prediction = -1 THEN 'ANOMALIA' ELSE 'NORMAL' END AS prediction_label,
        e.event_type <> 'error' AS success FROM p_scored JOIN events e ON row_key = e.event_id""",
)
def score_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Unreadable records are reported, never labelled normal."""
    detector, _ = trained(spark, folder)
    scored = scoring.score_json(record_text(spark, folder, True), "text", detector, "id_transaction")
    return scored.select(
        F.coalesce("id_transaction", F.lit(-1)).cast("bigint").alias("id_transaction"),
        F.coalesce("prediction", F.lit(0)).alias("prediction"),
        F.coalesce("prediction_label", F.lit("none")).alias("prediction_label"),
        "success",
    )


_GRID = [(64, 20), (128, 40)]
_GRID_CONTAMINATION = (0.05, 0.1)


def _grid_sql() -> str:
    ctes, outs = [f"WITH {SQL_MATRIX}"], []
    for i, (size, trees) in enumerate(_GRID):
        ctes.append(forest_sql.grow(f"g{i}", "plain", FEATURES, trees, 1.0, False, size))
        ctes.append(forest_sql.walk(f"g{i}", "plain", FEATURES, trees, size, 0.1, "true"))
        for c in _GRID_CONTAMINATION:
            outs.append(
                f"""SELECT {size} AS sub_sample, {trees} AS trees, {c}::DOUBLE AS contamination, count(*) AS total_samples,
                count_if(score < (SELECT quantile_cont(score, {c}::DOUBLE) FROM g{i}_raw)) AS anomalies_detected FROM g{i}_raw"""
            )
    return ",\n".join(ctes) + " " + " UNION ALL ".join(outs)


@query("iforest_grid", _grid_sql())
def iforest_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Forests over a grid of sizes, each read at several contamination levels."""
    rows = cut_lineage(featured(spark, folder))
    categories = encode.fit_categories(rows, features.CATEGORICAL_COLUMNS)
    matrix = scoring.prepare_matrix(rows, "id_transaction", categories)
    names = scoring.matrix_features(matrix)
    specs = [forests.Spec(trees, size) for size, trees in _GRID]
    nodes, used = forests.grow_all(matrix, "row_key", names, specs)
    fitted = forests.forests_of(nodes, names, specs, used)
    # every forest walks each row in one pass; all contamination levels are read from the written scores
    columns = [f"s{m}" for m in range(len(specs))]
    scores = cut_lineage(forests.with_all_scores(matrix, fitted).select(*[F.element_at("scores", m + 1).alias(c) for m, c in enumerate(columns)]))
    cuts = {(r["column_name"], r["prob"]): r["quantile"] for r in exact_quantiles(scores, columns, _GRID_CONTAMINATION).collect()}
    points = [(c, size, trees, share) for c, (size, trees) in zip(columns, _GRID) for share in _GRID_CONTAMINATION]
    counted = scores.agg(F.count("*").alias("n"), *[F.count_if(F.col(c) < cuts[c, share]).alias(f"a{k}") for k, (c, _, _, share) in enumerate(points)])
    each = F.explode(
        F.array(*[F.struct(F.lit(size).alias("sub_sample"), F.lit(trees).alias("trees"), F.lit(share).alias("contamination"),
                           F.col("n").alias("total_samples"), F.col(f"a{k}").alias("anomalies_detected"))
                  for k, (_, size, trees, share) in enumerate(points)])
    )
    return counted.select(each.alias("r")).select("r.*")


_FOLDS, _FOLD_TREES, _FOLD_ROWS, _FOLD_CONTAMINATION = 5, 24, 64, 0.1


def _cv_sql() -> str:
    marked = f"""marked AS MATERIALIZED (SELECT plain.*, e.event_type = 'error' AS actual,
        floor({sql_draw(42, "row_key")} * {_FOLDS})::INTEGER AS fold FROM plain JOIN events e ON row_key = e.event_id)"""
    ctes, outs = [f"WITH {SQL_MATRIX}", marked], []
    for f in range(_FOLDS):
        ctes.append(f"seen{f} AS (SELECT * FROM marked WHERE fold <> {f})")
        ctes.append(forest_sql.grow(f"c{f}", f"seen{f}", FEATURES, _FOLD_TREES, 1.0, False, _FOLD_ROWS, f"42:{f}", 42))
        ctes.append(forest_sql.walk(f"c{f}", "marked", FEATURES, _FOLD_TREES, _FOLD_ROWS, _FOLD_CONTAMINATION, f"fold <> {f}"))
        outs.append(f"""SELECT {f} AS fold, count(*) AS n, (SELECT count(*) FROM seen{f}) AS n_train, count_if(s.prediction = -1) AS flagged,
            round(count_if(s.prediction = -1 AND actual) / nullif(count_if(s.prediction = -1), 0), 6) AS precision,
            round(count_if(s.prediction = -1 AND actual) / nullif(count_if(actual), 0), 6) AS recall, round(avg(s.score), 6) AS mean_score
            FROM c{f}_scored s JOIN marked USING (row_key) WHERE marked.fold = {f}""")
    return ",\n".join(ctes) + " " + " UNION ALL ".join(outs)


@query("cv_forest", _cv_sql())
def cv_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Five folds, a forest fitted without each, every row judged by the forest that never saw it."""
    rows = cut_lineage(featured(spark, folder))
    categories = encode.fit_categories(rows, features.CATEGORICAL_COLUMNS)
    matrix = scoring.prepare_matrix(rows, "id_transaction", categories)
    names = scoring.matrix_features(matrix)
    marked = cut_lineage(folds(matrix, "row_key", _FOLDS))
    scored = forests.cross_validated(marked, "row_key", names, _FOLDS, _FOLD_CONTAMINATION, trees=_FOLD_TREES, sub_sample=_FOLD_ROWS)
    actual = table(spark, folder, "events").select(F.col("event_id").alias("row_key"), (F.col("event_type") == "error").alias("actual"))
    flagged = F.col("prediction") == decisions.ANOMALY
    by_fold = scored.select("row_key", "fold", "score", "prediction").join(actual, "row_key").groupBy("fold").agg(
        F.count("*").alias("n"), F.count_if(flagged).alias("flagged"),
        F.round(F.try_divide(F.count_if(flagged & F.col("actual")), F.count_if(flagged)), 6).alias("precision"),
        F.round(F.try_divide(F.count_if(flagged & F.col("actual")), F.count_if("actual")), 6).alias("recall"),
        F.round(F.avg("score"), 6).alias("mean_score"),
    )
    return by_fold.withColumn("n_train", F.lit(marked.count()) - F.col("n"))


def _decisions(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    decision = F.when(F.col("event_type") != "error", (F.col("value") - 50) / 50)
    return events.select(F.col("event_id").alias("id"), decision.alias("decision"), "value")


_SQL_DECISION = "CASE WHEN event_type <> 'error' THEN (value - 50) / 50 END"


@query(
    "confidence",
    f"""SELECT event_id AS id, round(coalesce(1 / (1 + exp(-abs({_SQL_DECISION}))), 0.5), 6) AS confidence_score FROM events""",
)
def confidence(spark: SparkSession, folder: str) -> DataFrame:
    rows = _decisions(spark, folder)
    return rows.select("id", F.round(decisions.logistic_confidence(F.col("decision")), 6).alias("confidence_score"))


@query(
    "confidence_minmax",
    """SELECT event_id AS id, round((value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER () + 1e-9), 6)
       AS confidence_score FROM events""",
)
def confidence_minmax(spark: SparkSession, folder: str) -> DataFrame:
    rows = _decisions(spark, folder)
    low, high = rows.agg(F.min("value")).scalar(), rows.agg(F.max("value")).scalar()
    return rows.select("id", F.round(decisions.range_confidence(F.col("value"), low, high), 6).alias("confidence_score"))


@query(
    "decision_label",
    f"""SELECT event_id AS id, CASE WHEN d >= 0 THEN 1 WHEN d < 0 THEN -1 ELSE 0 END AS prediction,
        CASE WHEN d >= 0 THEN 'NORMAL' WHEN d < 0 THEN 'ANOMALIA' ELSE 'none' END AS prediction_label
        FROM (SELECT event_id, {_SQL_DECISION} AS d FROM events)""",
)
def decision_label(spark: SparkSession, folder: str) -> DataFrame:
    label = decisions.label_from_decision(F.col("decision"))
    return _decisions(spark, folder).select(
        "id",
        F.coalesce(label, F.lit(0)).alias("prediction"),
        F.coalesce(decisions.label_text(label), F.lit("none")).alias("prediction_label"),
    )


@query(
    "score_threshold",
    """WITH s AS (SELECT event_id, -value AS score FROM events),
       q AS (SELECT quantile_cont(score, 0.1) AS t FROM s)
       SELECT event_id AS id, round(t, 6) AS threshold, CASE WHEN score >= t THEN 1 ELSE -1 END AS prediction FROM s, q""",
)
def score_threshold(spark: SparkSession, folder: str) -> DataFrame:
    """A detector with scores only: the lowest tenth of the whole table is anomalous."""
    rows = table(spark, folder, "events").select(F.col("event_id").alias("id"), (-F.col("value")).alias("score"))
    threshold = F.lit(exact_quantiles(rows, ["score"], [0.1]).first()["quantile"])
    return rows.select(
        "id",
        F.round(threshold, 6).alias("threshold"),
        decisions.label_from_threshold(F.col("score"), threshold).alias("prediction"),
    )
