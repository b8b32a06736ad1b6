"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import biblink

# Settings the library's results depend on (ANSI arithmetic, UTC wall clock,
# last-wins map keys for U2) plus the adaptive-execution switches that let
# Spark re-plan joins and coalesce partitions at runtime.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume to an existing session, and let the
    package's Python functions travel to the executors inside the tasks, so that it need not
    be installed there."""
    cloudpickle.register_pickle_by_value(biblink)
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "biblink") -> SparkSession:
    """A local session for tests and benchmarks (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BIBLINK_DRIVER_MEMORY", "16g"))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, read from the session.

    Only a session whose tasks run inside the driver (master ``local[n]``: tests
    and single-machine use) gets a temporary folder, removed when the process
    ends, if the setting is missing.  On a cluster that is an error: executors
    would write to their own disks.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="biblink-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: several readers share one
    computation, lineage is cut, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/biblink-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for work that its bytes do not show."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_for(spark: SparkSession, rows: int, task_rows: int) -> Iterator[None]:
    """Jobs that run inside deal their exchanges to one partition for every ``task_rows`` of their
    ``rows`` input rows, so that the memory of a task stays the same as the input grows.  Where
    these are no more than the cores, the session's settings stay."""
    n = -(-rows // task_rows)
    settings = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    if n <= spark.sparkContext.defaultParallelism:
        settings = {}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
