"""Tables in, and intermediate tables that survive the loss of executors.

``stage`` writes a DataFrame as Parquet below the folder of ``spark.checkpoint.dir``, which all
executors of a cluster share, and reads it back. That cuts the lineage of iterative jobs: what a
lost executor held is read again from there. Only where the setting is empty and the master is
local (tests, one machine) a folder of this machine is used.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_OWN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "millrace-stages")


def new_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    if not _OWN:
        atexit.register(_clear)
    _OWN.append((spark, path))
    return path


def stage(df: DataFrame, what: str = "stage", codec: str | None = None) -> DataFrame:
    path = new_path(df.sparkSession, what)
    df.write.parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind; else they stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def drop(df: DataFrame | None) -> None:
    """Deletes the files of a staged table that no later plan reads."""
    path = getattr(df, "_millrace_path", None)
    if path:
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _OWN[:] = [x for x in _OWN if x[1] != path]


def _clear() -> None:
    for spark, path in list(_OWN):
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may have ended already
            pass
