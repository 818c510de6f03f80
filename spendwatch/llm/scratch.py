"""Written stages that free the shuffles they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendwatch.session import cut_lineage

#: Spark's own switch: delete shuffle files once the action that made them is over.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Spark's own setting: rows in one Arrow batch.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files go with the write.

    ``batch_rows`` bounds the rows of an Arrow batch while it is written, for
    rows that hold long arrays or texts.
    """
    conf = df.sparkSession.conf
    wanted = {CLEANUP: "true"} | ({BATCH: str(batch_rows)} if batch_rows else {})
    before = {name: conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        conf.set(name, value)
    try:
        return cut_lineage(df)
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


#: Rows with whole texts in one Arrow batch.
TEXT_ROWS = 1_000


def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Lower the session's Arrow batches to ``rows`` rows, for plans over whole texts; smaller ones stay."""
    if int(spark.conf.get(BATCH)) > rows or int(spark.conf.get(BATCH)) <= 0:
        spark.conf.set(BATCH, str(rows))
