"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import SparkSession

# AQE re-plans joins and splits skewed partitions at run time; the session time
# zone is fixed so that years and seasons do not depend on the machine.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "catchframe", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the library's settings; ``master`` stays unset on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Working folders that this driver has named, oldest first.
_FOLDERS: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Only a session with master ``local`` or ``local[n]`` and without that setting, which has
    one machine and no executors of its own, gets a folder under the warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/working"
    _FOLDERS.append(f"{base.rstrip('/')}/catchframe-{uuid.uuid4().hex}")
    return _FOLDERS[-1]


def working_folders() -> list[str]:
    """The working folders named so far."""
    return list(_FOLDERS)


def release(spark: SparkSession, folders: Iterable[str]) -> None:
    """Remove working folders whose tables no later job reads, such as those of a finished stage."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        _FOLDERS.remove(folder)
