"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}

#: Bytes of a batch between the JVM and a Python worker. Each side holds one or two of every task at once, and Spark's own bound
#: is 64 MB. A row is never cut, so a larger one is a batch of its own.
BATCH_BYTES = 4 << 20
#: Rows of a batch of a Parquet scan of texts. Spark's own 4,096 make arrays of many megabytes, for which a heap grows.
SCAN_ROWS = 512
_SCAN_SETTING = "spark.sql.parquet.columnarReaderBatchSize"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(cpus: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the given one."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reedbed")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # No call-site capture per column call: it is most of the time it takes to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return show_package(session)


def show_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from the folder it was loaded from.

    For a checkout that the executors see too; elsewhere install the package or pass it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return bound_batches(spark)


def bound_batches(spark: SparkSession) -> SparkSession:
    """Bound the bytes of Arrow batches, unless the session has a bound of its own."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return spark


def bound_scans(spark: SparkSession) -> SparkSession:
    """Bound the rows of a scan's batches for long texts, unless the session has a bound of its own."""
    if spark.conf.get(_SCAN_SETTING, None) is None:
        spark.conf.set(_SCAN_SETTING, str(SCAN_ROWS))
    return spark


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within this block Spark deletes the shuffle files of a query as soon as it has ended."""
    before = spark.conf.get(_CLEANUP_SETTING, None)
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_SETTING)
        else:
            spark.conf.set(_CLEANUP_SETTING, before)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder is used in local mode only: on a
    cluster the executors could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        base = _local_scratch.get(app) or _local_scratch.setdefault(app, tempfile.mkdtemp(prefix="reedbed-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several later branches read the same intermediate: it cuts the
    lineage, survives lost executors, and gives the planner a true size, so a
    small result is broadcast and a large one is not.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
