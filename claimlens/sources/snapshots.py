"""Timestamped snapshots: one partition per run, the newest one read back."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.operators.features import ROW_ID, Prepared

SNAPSHOT = "snapshot"
BUNDLE = ["dataset", "information", "variables"]
COMPLETE = "_SUCCESS"  # what the writer leaves last
MANIFESTS = "manifests"


def stamp(now: datetime) -> str:
    """``20250106_0900``: sorts as text in time order."""
    return now.strftime("%Y%m%d_%H%M")


def newest(names: Sequence[str], text: str) -> str:
    """The last name, in text order, that contains ``text``."""
    found = sorted(n for n in names if text in n)
    if not found:
        raise FileNotFoundError(f"nothing named like {text!r}")
    return found[-1]


def save_snapshot(df: DataFrame, root: str, when: str) -> None:
    """Write one snapshot; a rerun replaces its own partition and no other."""
    df.write.mode("overwrite").parquet(f"{root}/{SNAPSHOT}={when}")


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("basePath", root).parquet(root).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("string"))


def _store(spark: SparkSession, path: str):
    """The Hadoop path and the file system that it lies in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, folder: str) -> dict[str, str]:
    """Name and path of what lies in a folder; no file is opened. A missing folder holds nothing."""
    path, store = _store(spark, folder)
    if not store.exists(path):
        return {}
    return {s.getPath().getName(): s.getPath().toString() for s in store.listStatus(path)}


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file, whole or not at all: it is written beside its place and gets its name by a rename, which
    fails if the name is taken."""
    target, store = _store(spark, path)
    written = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{uuid.uuid4().hex}")
    out = store.create(written, False)
    out.write(bytearray(text.encode()))
    out.close()
    if store.exists(target) or not store.rename(written, target):
        raise FileExistsError(path)


def stamps(spark: SparkSession, root: str) -> list[str]:
    """Stamps of the complete snapshots below ``root``, oldest first, with or without rows in them.

    A snapshot is complete once its writer has left the marker that it writes last.
    """
    folders = {n: p for n, p in listed(spark, root).items() if n.startswith(f"{SNAPSHOT}=")}
    done = [n for n, path in folders.items() if COMPLETE in listed(spark, path)]
    return sorted(n.removeprefix(f"{SNAPSHOT}=") for n in done)


def latest_snapshot(spark: SparkSession, root: str) -> str:
    """Newest stamp below ``root``."""
    found = stamps(spark, root)
    if not found:
        raise FileNotFoundError(f"no snapshot in {root}")
    return found[-1]


def read_snapshot(spark: SparkSession, root: str, when: str) -> DataFrame:
    """Rows of one snapshot; no other folder is listed or read."""
    return spark.read.parquet(f"{root}/{SNAPSHOT}={when}")


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the newest snapshot, none if it was saved without any."""
    return read_snapshot(spark, root, latest_snapshot(spark, root))


def save_tables(tables: Mapping[str, DataFrame], root: str, when: str) -> str:
    """Store the tables of one bundle under a stamp; returns the path of its manifest.

    Each run writes to folders of its own, and last a manifest that names them. Readers follow manifests, so
    they see the tables of one run, all of them: a run that stops before has changed nothing, and a rerun
    under a stamp takes effect at once. The manifest gets its name by a rename after it is written; of two runs
    that claim one number, the second fails.
    """
    spark = next(iter(tables.values())).sparkSession
    run = uuid.uuid4().hex
    paths = {name: f"{root}/prepared/runs/{run}/{name}" for name in tables}
    for name, table in tables.items():
        table.write.parquet(paths[name])
    folder = f"{root}/prepared/{MANIFESTS}"
    earlier = [n for n in listed(spark, folder) if n.startswith(f"{when}.")]
    target = f"{folder}/{when}.{len(earlier) + 1:06d}.json"
    write_file(spark, target, json.dumps({"stamp": when, "run": run, "tables": sorted(tables)}))
    return target


def save_bundle(prepared: Prepared, root: str, when: str) -> None:
    """Prepared data as three tables under the stamp of the snapshot it came from."""
    frames = (prepared.dataset(), prepared.info(), prepared.variables().coalesce(1))
    save_tables(dict(zip(BUNDLE, frames, strict=True)), root, when)


def _manifests(spark: SparkSession, root: str) -> dict[str, str]:
    """Stamp and path of the newest manifest of every stamp."""
    names = listed(spark, f"{root}/prepared/{MANIFESTS}")
    return {n.split(".")[0]: names[n] for n in sorted(names) if n.endswith(".json")}


def _bundles(spark: SparkSession, root: str) -> dict[str, str | None]:
    """Every stamp with the manifest of its bundle; None where three complete snapshots are one, as they were
    stored before there were manifests."""
    plain = set.intersection(*[set(stamps(spark, f"{root}/prepared/{name}")) for name in BUNDLE])
    return dict.fromkeys(plain) | _manifests(spark, root)


def latest_bundle(spark: SparkSession, root: str) -> str:
    """The newest stamp under which there is a whole bundle."""
    found = _bundles(spark, root)
    if not found:
        raise FileNotFoundError(f"no complete bundle in {root}")
    return max(found)


def read_bundle(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The newest bundle; its tables are of one run and share the row id."""
    bundles = _bundles(spark, root)
    if not bundles:
        raise FileNotFoundError(f"no complete bundle in {root}")
    when = max(bundles)
    if bundles[when] is None:
        return {name: read_snapshot(spark, f"{root}/prepared/{name}", when) for name in BUNDLE}
    manifest = json.loads(spark.read.text(bundles[when], wholetext=True).first().value)
    return {name: spark.read.parquet(f"{root}/prepared/runs/{manifest['run']}/{name}") for name in manifest["tables"]}


def join_bundle(bundle: Mapping[str, DataFrame]) -> DataFrame:
    """Information and features of a stored bundle in one frame again."""
    return bundle["information"].join(bundle["dataset"], ROW_ID)


def save_frames(frames: Mapping[str, DataFrame] | Sequence[DataFrame], root: str, fmt: str = "parquet", mode: str = "overwrite") -> list[str]:
    """Several frames as named outputs: keys name them, a list is named ``sheet0``, ``sheet1``, …"""
    named = frames.items() if isinstance(frames, Mapping) else ((f"sheet{i}", f) for i, f in enumerate(frames))
    paths = []
    for name, frame in named:
        path = f"{root}/{name}"
        frame.write.mode(mode).format(fmt).options(**({"header": True} if fmt == "csv" else {})).save(path)
        paths.append(path)
    return paths
