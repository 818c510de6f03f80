"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch: delete shuffle files once the action that made them is over.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "spendwatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    AQE coalesces partitions and splits skewed join partitions at run time, so
    no operator fixes a partition count of its own.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a
    cluster without it is a configuration error, since a machine-local folder
    would vanish with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spendwatch-"))
    return context.getCheckpointDir().rstrip("/")


_handed_out: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def scratch_mark() -> int:
    """Where the paths handed out from now on begin, for :func:`release_scratch`."""
    return len(_handed_out)


def release(*tables: DataFrame) -> None:
    """Delete the written stages that ``tables`` read, once nothing reads them any more.

    For tables from :func:`cut_lineage` and unions of them: whatever else in the
    shared folder a table reads would go as well.
    """
    files = [file for table in tables for file in table.inputFiles()]
    for name in [p for p in _handed_out if any(f"/{p.rsplit('/', 1)[-1]}/" in file for file in files)]:
        _handed_out.remove(name)
        _delete(tables[0].sparkSession, name)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_scratch(spark: SparkSession, since: int = 0, keep_last: bool = False) -> None:
    """Delete what this process wrote to the shared folder, once its results are no longer read.

    ``since`` leaves what was handed out before that mark, ``keep_last`` the
    newest path, which a chain of steps still reads.
    """
    paths = _handed_out[since:]
    kept = paths[-1:] if keep_last else []
    _handed_out[since:] = kept
    for name in paths[: len(paths) - len(kept)]:
        _delete(spark, name)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    The result survives the loss of any executor, and later passes read only
    the columns they need, with sizes the optimizer knows.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write go with it instead of waiting for the driver's garbage collection."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
