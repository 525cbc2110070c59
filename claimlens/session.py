"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# SQL settings every plan in this package relies on. Partition counts stay with the
# cluster: AQE coalesces small shuffle partitions and splits skewed ones.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when an aggregate on the same key follows it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def with_package(spark: SparkSession) -> SparkSession:
    """Python workers that start from now on find this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    places = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in places:
        environment["PYTHONPATH"] = os.pathsep.join([root, *places])
    return spark


def tune(spark: SparkSession) -> SparkSession:
    for name, value in PLAN_SETTINGS.items():
        spark.conf.set(name, value)
    return with_package(spark)


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("claimlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="claimlens-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


# Paths handed out and not removed yet.
_handed_out: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/claimlens/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def staged_paths(since: int = 0) -> list[str]:
    """Paths handed out and not removed yet, from the ``since``-th on."""
    return _handed_out[since:]


def remove_staged(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete what this process has staged so far, or those of ``paths``; frames that read it must be done with.
    Gives the number of paths."""
    removed = 0
    for name in list(_handed_out if paths is None else paths):
        if name in _handed_out:
            _handed_out.remove(name)
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result once and continue from the written table.

    Later readers prune its columns, its file sizes feed join planning, and a lost
    executor costs a re-read instead of a recomputation.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
