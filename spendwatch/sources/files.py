"""Raw transaction, user and lookup files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Input names, and the columns each input must have.
TRANSACTIONS_FILE = "transactions_data.csv"
USERS_FILE = "users_data.csv"
MCC_FILE = "mcc_codes.json"
REQUIRED_TRANSACTION_COLUMNS = ("client_id", "mcc")
REQUIRED_USER_COLUMNS = ("id",)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV with an explicit schema: one pass, no inference scan."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json_map(spark: SparkSession, path: str, value_type: str = "string") -> DataFrame:
    """A JSON object file as rows ``(key, value)``.

    One JSON object is one record to any JSON reader, so these files are
    dimensions; the rows are split out before anything else touches them.
    """
    text = spark.read.text(path, wholetext=True)
    return json_map_rows(text, F.col("value"), value_type)


def json_map_rows(df: DataFrame, text, value_type: str = "string") -> DataFrame:
    """Explode JSON object text into ``(key, value)`` rows."""
    parsed = F.from_json(text, f"map<string,{value_type}>")
    return df.select(F.explode(parsed).alias("key", "value"))


def require_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Fail before any work when an input is missing, naming all that are."""
    missing = [path for path in paths if not _exists(spark, path)]
    if missing:
        raise FileNotFoundError(f"inputs not found: {', '.join(missing)}")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException:
        return False
    return True


def require_columns(df: DataFrame, required: Iterable[str], name: str) -> DataFrame:
    """Check the analyzed schema; no data is read."""
    needed = set(required)
    if not needed <= set(df.columns):
        raise ValueError(f"{name} lacks required columns {sorted(needed - set(df.columns))}")
    return df


def load_raw(
    spark: SparkSession, folder: str, transactions: StructType | str, users: StructType | str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transactions, users and MCC lookup from a raw-data folder."""
    paths = [f"{folder}/{name}" for name in (TRANSACTIONS_FILE, USERS_FILE, MCC_FILE)]
    require_paths(spark, paths)
    tx = require_columns(
        read_csv(spark, paths[0], transactions), REQUIRED_TRANSACTION_COLUMNS, "transactions"
    )
    people = require_columns(read_csv(spark, paths[1], users), REQUIRED_USER_COLUMNS, "users")
    mcc = read_json_map(spark, paths[2]).select(
        F.col("key").cast("int").alias("mcc"), F.col("value").alias("mcc_description")
    )
    return tx, people, mcc


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_report(results: DataFrame, path: str, metadata: dict[str, str]) -> None:
    """Per-model metric rows with run metadata, as JSON records."""
    tagged = results.withColumns({f"meta_{k}": F.lit(v) for k, v in metadata.items()})
    tagged.write.mode("overwrite").json(path)


def label_map(pairs: DataFrame) -> DataFrame:
    """Ids flagged 1, from ``(key, value)`` rows; non-numeric keys are ignored."""
    return pairs.filter(F.col("key").rlike("^[0-9]+$") & (F.col("value") == 1)).select(
        F.col("key").cast("bigint").alias("id")
    )
