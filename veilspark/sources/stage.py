"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LIVE: dict[str, SparkSession] = {}


class NoSharedFolder(Exception):
    """Staging needs a folder that the driver and all executors share."""


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only where driver and executors are one process (a ``local`` master) may it
    be unset: then a new temporary folder serves.  Elsewhere each executor would
    write to its own disk and the read-back would miss files, so this raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise NoSharedFolder("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-")


def stage_path(spark: SparkSession, folder: str | None = None) -> str:
    """A new path in ``folder`` or in the shared folder, dropped when the driver
    ends if nobody drops it before."""
    path = f"{folder or shared_folder(spark)}/_scan-{uuid.uuid4().hex}"
    _LIVE[path] = spark
    return path


def staged(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` written once and read back: later steps neither recompute it nor
    lose it with an executor."""
    spark = df.sparkSession
    path = path or stage_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _LIVE.pop(path, None)


def live_stages() -> set[str]:
    """Paths of the stages that are still there."""
    return set(_LIVE)


def drop_unread(paths: set[str], *kept: DataFrame) -> set[str]:
    """Drop those of ``paths`` that no frame in ``kept`` reads; returns the others."""
    read = [f for df in kept for f in df.inputFiles()]
    used = {p for p in paths & live_stages() if any(p.rsplit("/", 1)[1] in f for f in read)}
    for path in paths & live_stages() - used:
        drop_stage(_LIVE[path], path)
    return used


def drop_all(spark: SparkSession | None = None) -> None:
    """Drop every stage that is still there (of one session, or of all)."""
    for path, owner in list(_LIVE.items()):
        if spark is None or owner is spark:
            try:
                drop_stage(owner, path)
            except Exception:  # the JVM may be gone when the driver ends
                _LIVE.pop(path, None)


atexit.register(drop_all)
