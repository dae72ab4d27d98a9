"""Session settings the library relies on, and the shared scratch location.

The engine never builds its own cluster session: ``pin_session`` only sets
SQL-level options that results depend on (time zone, ANSI mode, dynamic
partition overwrite).  ``local_session`` is for tests and the bench.
"""
from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Options whose values change query results; set on every session we touch.
RESULT_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.parquet.compression.codec": "snappy",
}


def pin_session(spark: SparkSession) -> SparkSession:
    for key, value in RESULT_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "tillroll") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # one listing task per folder is right on a cluster; locally a few suffice
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in RESULT_OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin_session(spark)


@contextlib.contextmanager
def small_tasks_apart(spark: SparkSession) -> Iterator[None]:
    """Within it AQE does not put small shuffle partitions into one task."""
    option = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(option)
    spark.conf.set(option, "false")
    try:
        yield
    finally:
        spark.conf.set(option, before)


@contextlib.contextmanager
def folders_listed_together(spark: SparkSession) -> Iterator[None]:
    """Within it a listing of many folders takes four tasks a core at most, not
    one a folder: a task costs more than listing a folder."""
    option = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(option)
    spark.conf.set(option, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(option, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local master may go without the setting: a folder of this machine
    is then created and registered.  On any other master executors would not
    see each other's files there, so an unset folder raises.
    """
    sc = spark.sparkContext
    current = (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
               or spark.conf.get("spark.checkpoint.dir", None))
    if not current:
        if not is_local(sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set on master {sc.master}: "
                               "scratch data needs a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def is_local(master: str) -> bool:
    """True for ``local``, ``local[n]``; not for ``local-cluster[...]``."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tillroll/{name}-{uuid.uuid4().hex[:12]}"
