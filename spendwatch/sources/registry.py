"""Model artifacts as Parquet tables, one partition per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendwatch.operators.iforest import NODE_SCHEMA, Forest
from spendwatch.operators.scale import Scaler
from spendwatch.operators.scoring import Detector

# Name patterns tried in turn; the first with a match decides.
LATEST_PATTERNS = ("isolation_forest.*\\.joblib$", "\\.joblib$")
ALL_PATTERNS = ("_i3_optimized_.*\\.joblib$", "\\.joblib$", "\\.pkl$")

TABLES = ("nodes", "features", "scaler", "categories", "meta")
RUN = ("model_type", "run_ts")
META_SCHEMA = "trees int, sub_sample int, offset double, contamination double, has_scaler boolean, n_nodes int, n_features int"


def save_detector(spark: SparkSession, detector: Detector, root: str, run_ts: str) -> None:
    """Store a run: trees, ordered features, scaling, categories, then meta data.

    A run's folders are written anew, so saving it again (a retry) changes
    nothing; meta data, written last, says how many rows belong to it.
    """
    forest, scaler = detector.forest, detector.scaler
    tables = {
        "nodes": spark.createDataFrame(list(forest.nodes), NODE_SCHEMA),
        "features": spark.createDataFrame(
            list(enumerate(detector.features)), "position int, feature string"
        ),
        "categories": spark.createDataFrame(
            [(c, i, v) for c, values in detector.categories.items() for i, v in enumerate(values)],
            "column_name string, position int, value string",
        ),
        "meta": spark.createDataFrame(
            [(forest.trees, forest.sub_sample, forest.offset, forest.contamination, scaler is not None, len(forest.nodes), len(detector.features))],
            META_SCHEMA,
        ),
    }
    if scaler is not None:
        rows = zip(range(len(scaler.names)), scaler.names, scaler.means, scaler.deviations, strict=True)
        tables["scaler"] = spark.createDataFrame(
            list(rows), "position int, feature string, mean double, deviation double"
        )
    for name in sorted(tables, key=lambda n: n == "meta"):
        folder = f"{root}/{name}/model_type={detector.model_type}/run_ts={run_ts}"
        tables[name].coalesce(1).write.mode("overwrite").parquet(folder)


def _run(spark: SparkSession, root: str, table: str, model_type: str, run_ts: str) -> list:
    schema = {
        "nodes": NODE_SCHEMA,
        "features": "position int, feature string",
        "scaler": "position int, feature string, mean double, deviation double",
        "categories": "column_name string, position int, value string",
        "meta": META_SCHEMA,
    }[table]
    stored = spark.read.schema(f"{schema}, model_type string, run_ts string").parquet(f"{root}/{table}")
    mine = stored.filter((F.col("model_type") == model_type) & (F.col("run_ts") == run_ts))
    return mine.drop(*RUN).collect()


def load_detector(spark: SparkSession, root: str, model_type: str, run_ts: str) -> Detector:
    """Read a run back; a run without scaling is served unscaled, one without trees is refused."""
    meta = _run(spark, root, "meta", model_type, run_ts)
    nodes = _run(spark, root, "nodes", model_type, run_ts)
    names = sorted(_run(spark, root, "features", model_type, run_ts), key=lambda r: r["position"])
    if not meta or not nodes:
        raise ValueError(f"no usable model {model_type} {run_ts} in {root}")
    if not names:
        raise ValueError(f"model {model_type} {run_ts} has no feature list; train it again")
    if (len(nodes), len(names)) != (meta[0]["n_nodes"], meta[0]["n_features"]):
        raise ValueError(f"model {model_type} {run_ts} is incomplete; save it again")
    features = tuple(r["feature"] for r in names)
    scaler = None
    if meta[0]["has_scaler"]:
        rows = sorted(_run(spark, root, "scaler", model_type, run_ts), key=lambda r: r["position"])
        scaler = Scaler(
            tuple(r["feature"] for r in rows), tuple(r["mean"] for r in rows), tuple(r["deviation"] for r in rows)
        )
    categories: dict[str, list[str]] = {}
    for r in sorted(_run(spark, root, "categories", model_type, run_ts), key=lambda r: (r["column_name"], r["position"])):
        categories.setdefault(r["column_name"], []).append(r["value"])
    forest = Forest(
        features,
        tuple(tuple(n) for n in nodes),
        meta[0]["trees"],
        meta[0]["sub_sample"],
        meta[0]["offset"],
        meta[0]["contamination"],
    )
    return Detector(model_type, run_ts, features, categories, scaler, forest)


def list_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/meta").select(*RUN, "has_scaler").distinct()


def latest_detector(spark: SparkSession, root: str) -> Detector:
    """Newest run, forests first."""
    rank = F.when(F.col("model_type") == "isolation_forest", 0).otherwise(1)
    newest = list_runs(spark, root).orderBy(rank, F.desc("run_ts")).first()
    if newest is None:
        raise FileNotFoundError(f"no model in {root}")
    return load_detector(spark, root, newest["model_type"], newest["run_ts"])


def status(detector: Detector) -> dict[str, object]:
    return {
        "type": detector.model_type,
        "path": detector.run,
        "features_count": len(detector.features),
        "has_scaler": detector.scaler is not None,
    }


def list_artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """Names and times of the files in a folder, without their contents."""
    files = spark.read.format("binaryFile").load(folder)
    return files.select(
        F.substring_index("path", "/", -1).alias("name"), F.col("modificationTime").alias("mtime")
    )


def pattern_rank(name: Column, patterns: tuple[str, ...]) -> Column:
    """Position of the first pattern a name matches, NULL when none does."""
    rank = F.lit(None).cast("int")
    for i in reversed(range(len(patterns))):
        rank = F.when(name.rlike(patterns[i]), F.lit(i)).otherwise(rank)
    return rank


def latest_artifact(artifacts: DataFrame) -> DataFrame:
    """The newest file of the best matching pattern, as one row."""
    ranked = artifacts.withColumn("rank", pattern_rank(F.col("name"), LATEST_PATTERNS)).filter("rank IS NOT NULL")
    best = F.max_by(F.struct("name", "mtime"), F.struct(-F.col("rank"), F.col("mtime"), F.col("name")))
    return ranked.agg(best.alias("b")).select("b.*")


def matching_artifacts(artifacts: DataFrame) -> DataFrame:
    """All files of the first pattern that matches anything."""
    ranked = artifacts.withColumn("rank", pattern_rank(F.col("name"), ALL_PATTERNS)).filter("rank IS NOT NULL")
    return ranked.filter(F.col("rank") == ranked.agg(F.min("rank")).scalar()).drop("rank")
