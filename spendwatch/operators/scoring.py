"""One scoring function for batches, single records and streams."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from spendwatch.functions import decisions
from spendwatch.operators.encode import align, fit_categories, one_hot, to_matrix
from spendwatch.operators.features import CATEGORICAL_COLUMNS, drop_columns
from spendwatch.operators.iforest import Forest, fit_forest, with_scores
from spendwatch.operators.sampling import sample_exact, split_exact
from spendwatch.operators.scale import Scaler, apply_scaler, fit_scaler
from spendwatch.session import cut_lineage

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Detector:
    """Everything needed to score a raw featured row."""

    model_type: str
    run: str
    features: tuple[str, ...]
    categories: dict[str, list[str]] = field(default_factory=dict)
    scaler: Scaler | None = None
    forest: Forest | None = None


def prepare_matrix(
    featured: DataFrame,
    key: str,
    categories: dict[str, list[str]],
    keep_ids: bool = False,
) -> DataFrame:
    """Featured rows to key plus float features: drop, encode, fill, cast."""
    tagged = featured.withColumn("_row_key", F.col(key))
    encoded = one_hot(drop_columns(tagged, keep_ids), categories)
    return to_matrix(encoded, keep=["_row_key"]).withColumnRenamed("_row_key", "row_key")


def prepare_training(
    featured: DataFrame,
    key: str,
    fraction: float = 0.01,
    share: float = 0.15,
    seed: object = 42,
    keep_ids: bool = False,
    categorical: Sequence[str] = CATEGORICAL_COLUMNS,
) -> tuple[DataFrame, dict[str, list[str]]]:
    """Sampled, encoded float matrix with its ``is_test`` part marked.

    The sample and the split use different hash seeds, and categories come from
    training rows only, so both parts share one column set.
    """
    sampled = featured if fraction >= 1 else sample_exact(featured, key, fraction, seed=f"{seed}:sample")
    # Fitting reads the sample several times; without this each pass would
    # redo the join and the client means over the whole table.
    stored = cut_lineage(sampled)
    parts = split_exact(stored, key, share, f"{seed}:split")
    categories = fit_categories(parts.filter("NOT is_test"), categorical)
    flags = parts.withColumnRenamed("is_test", "_is_test")
    encoded = one_hot(drop_columns(flags.withColumn("_row_key", F.col(key)), keep_ids), categories)
    matrix = to_matrix(encoded, keep=["_row_key", "_is_test"])
    return matrix.withColumnsRenamed({"_row_key": "row_key", "_is_test": "is_test"}), categories


def matrix_features(matrix: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in matrix.columns if c not in ("row_key", "is_test"))


def train(matrix: DataFrame, categories: dict[str, list[str]], run: str, scaled: bool = True, **forest) -> Detector:
    """Scale the training rows and fit a forest on them."""
    features = matrix_features(matrix)
    rows = matrix.filter("NOT is_test") if "is_test" in matrix.columns else matrix
    scaler = fit_scaler(rows, features) if scaled else None
    ready = apply_scaler(rows, scaler, keep=["row_key"])
    fitted = fit_forest(ready, "row_key", features, **forest)
    return Detector("isolation_forest", run, features, categories, scaler, fitted)


def score(df: DataFrame, detector: Detector, keep: Iterable[str]) -> DataFrame:
    """Label every row: encode, align, scale, isolate, decide.

    Only narrow projections and one Arrow-batched function, so the plan adds no
    shuffle to the scan and runs unchanged on a stream.
    """
    keep = list(keep)
    carried = df.withColumns({f"_keep_{c}": F.col(c) for c in keep})
    encoded = one_hot(carried, {c: v for c, v in detector.categories.items() if c in df.columns}, drop_first=False)
    aligned = align(encoded, detector.features, keep=[f"_keep_{c}" for c in keep])
    ready = apply_scaler(aligned, detector.scaler, keep=[f"_keep_{c}" for c in keep])
    label = decisions.label_from_decision(F.col("decision"))
    scored = with_scores(ready, detector.forest)
    return scored.select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        "path_length",
        "score",
        "decision",
        label.alias("prediction"),
        decisions.label_text(label).alias("prediction_label"),
        decisions.logistic_confidence(F.col("decision")).alias("confidence_score"),
        F.lit(detector.model_type).alias("model_type"),
        F.lit(detector.run).alias("model_path"),
        F.lit(True).alias("success"),
    )


def record_schema(detector: Detector, key: str) -> StructType:
    """Schema of one JSON record: key, raw categories, numeric features."""
    schema = StructType([StructField(key, LongType())])
    encoded = {f"{c}_{v}" for c, values in detector.categories.items() for v in values}
    for name in detector.categories:
        schema.add(StructField(name, StringType()))
    for name in detector.features:
        if name not in encoded:
            schema.add(StructField(name, DoubleType()))
    return schema.add(StructField(CORRUPT, StringType()))


def parse_records(text: DataFrame, column: str, schema: StructType) -> DataFrame:
    """JSON text to typed rows; ``_corrupt_record`` holds text that does not fit."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return text.select(F.from_json(column, schema, options).alias("r")).select("r.*")


def score_json(
    text: DataFrame, column: str, detector: Detector, key: str, fail_open: bool = False
) -> DataFrame:
    """Score JSON records; unreadable ones come back unlabelled with ``success`` false.

    ``fail_open`` labels them normal with confidence 0 instead, which hides
    failures and is therefore opt-in.
    """
    parsed = parse_records(text, column, record_schema(detector, key))
    scored = score(parsed, detector, keep=[key, CORRUPT])
    bad = F.col(CORRUPT).isNotNull()
    when_bad = lambda value, name: F.when(bad, value).otherwise(F.col(name)).alias(name)
    fallback = F.lit(decisions.NORMAL) if fail_open else F.lit(None).cast("int")
    return scored.select(
        key,
        when_bad(fallback, "prediction"),
        when_bad(decisions.label_text(fallback), "prediction_label"),
        when_bad(F.lit(0.0), "confidence_score"),
        "model_type",
        "model_path",
        (~bad).alias("success"),
        F.when(bad, F.concat(F.lit("unreadable record: "), F.col(CORRUPT))).alias("error"),
    )
