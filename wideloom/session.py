"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Spark removes a finished query's shuffle files at once, not when the driver collects its garbage
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "wideloom") -> SparkSession:
    """Session used by tests and the benchmark.

    AQE stays on (runtime coalescing, skew-join splitting, broadcast of
    small runtime sides).  The session time zone is pinned to UTC so date
    and epoch formatting is reproducible.  The UI stays off.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: let post-shuffle stages keep all cores busy
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets it to a shared file
    system; we only fill it in when it is unset (local runs and tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a driver-side context
        sc = None
    current = spark.conf.get(CHECKPOINT_KEY, None)
    if not current and sc is not None:
        current = sc.getConf().get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not current:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="wideloom-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for written tables)."""
    return "/".join([ensure_checkpoint_dir(spark), *parts])


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written inside go as soon as each write is done: for tables
    that end a lineage, whose files nothing reads again."""
    before = spark.conf.get(CLEANUP_KEY, None)
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_KEY)
        else:
            spark.conf.set(CLEANUP_KEY, before)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
