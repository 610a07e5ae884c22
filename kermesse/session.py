"""Session helpers. A cluster's own settings always win."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the local bench."""
    return (SparkSession.builder.master(f"local[{cores}]").appName("kermesse")
            .config("spark.sql.shuffle.partitions", str(partitions))
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.driver.memory", memory)
            .config("spark.ui.enabled", "false")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        named = tempfile.mkdtemp(prefix="kermesse-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def stage(df: DataFrame) -> DataFrame:
    """Write a step that several branches read, so none of them computes it again.

    The files live in the shared checkpoint folder and outlast a lost executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when a scan has fewer splits than half of them.

    One small file with one row group is a single split; on a cluster the scan of a large
    table already has many and this changes nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application; Arrow steps import it there."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='kermesse-')}/kermesse", "zip", root.parent, root.name)
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
