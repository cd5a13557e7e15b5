"""Session helpers.  Library functions take a session; they never create one,
except ``local_session`` which tests and the bench use."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE stays on: it coalesces small shuffles,
# turns joins into broadcast joins only after measuring the built side, and
# splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "commerce_lake",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir`` when set; only a local test
    session without one gets a fresh scratch folder.  A cluster without one is
    an error: a node's own folder is invisible to the others."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="cl-ckpt-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(path)
    return path


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Bytes of memory that a row of a broadcast table takes at least: key, slot and row (64 measured for a single long).
BROADCAST_ROW = 64


def fits_broadcast(spark: SparkSession, rows: int) -> bool:
    """Whether so many rows lie within the session's broadcast threshold once they are in memory.

    The planner compares the threshold with the size of compressed, column-pruned files, which
    for a key column is a tenth of that or less."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)([kmgt]?)b?", text).groups()
    return rows * BROADCAST_ROW <= int(number) * 1024 ** " kmgt".index(unit or " ")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a write's shuffle files go when the write ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the library's own, wherever the session's file systems have it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
